"""newsmill: content-intelligence analytics on Spark DataFrames.

Landed feeds, paper listings and vulnerability records are normalised to one
article table, deduplicated, checked against what was already sent, triaged,
filtered by policy, ranked and turned into daily digests.
"""
