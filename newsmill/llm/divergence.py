"""Divergence audit of sources: how far each one's words are from its peers' and its language's.

Documents are counted to one row per language, source and term. The pairs of sources of a
language are compared by Gustavson's row accumulation: the counts are dealt out by blocks
of terms, a block is indexed by term, and each source scatters its terms through that index
into one dense accumulator over its peers. A pair of postings is never a row. Terms that
one or both of two sources lack have a share that depends on the source only (its zero
baseline); they are added for whole sources, from how often each share occurs there.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsmill.llm.common import arrow_columns, small_batches
from newsmill.session import materialize

#: Counts held by a task before they are passed on.
HELD = 400_000
#: Rows of the table of groups that are broadcast at most; beyond it Spark joins by shuffle.
BROADCAST_GROUPS = 100_000
#: Postings of a block, and at least so many for each group of the language, so that
#: accumulators stay smaller than what they sum up.
BLOCK, BLOCK_PER_GROUP = 16_000, 64
#: Pairs that are in memory at a time while they are summed up.
STEP = 1 << 20
#: Letters of A-Z in lower case; other ASCII separates terms, all else belongs to them.
_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256)).lower()


@dataclass(frozen=True)
class Settings:
    """Documents of a language that hold a term at least, counts added to each, and terms listed per group."""

    min_docs: int = 10
    added: int = 2
    top: int = 10


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode().translate(_LETTERS).split()


def _counted(docs: DataFrame) -> DataFrame:
    """Rows ``(lang, source, term, n, docs)``, several for a term: occurrences, and documents with one."""
    schema = "lang string, source string, term string, n long, docs long"
    names = [f.split()[0] for f in schema.split(", ")]

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, within) in held.items():
            size = len(counts)
            if size == 0:
                continue
            columns = [
                pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                pa.array(list(counts), pa.binary()).cast(pa.string()),
                pa.array(list(counts.values()), pa.int64()), pa.array([within[t] for t in counts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = defaultdict(lambda: (Counter(), Counter()))
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(c for c in batch.columns), strict=True):
                terms = terms_of(text.as_py())
                counts, within = held[lang.as_py(), source.as_py()]
                size -= len(counts)
                counts.update(terms)
                within.update(set(terms))
                size += len(counts)
                if size > HELD:
                    yield from flush(held)
                    held.clear()
                    size = 0
        yield from flush(held)

    return docs.select("lang", "source", "text").mapInArrow(run, schema)


def share(count: str, total: str, kept: str, added: int) -> Column:
    """``1 + floor(10 ** 9 * (count + added) / (total + added * kept))`` of columns, exact; 1 without kept terms."""
    share = F.expr(f"cast(1000000000 as decimal(10, 0)) * ({count} + {added}) div ({total} + {added} * {kept})")
    return F.when(F.col(kept) > 0, share + 1).otherwise(F.lit(1).cast("long"))


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def row_sums(term: np.ndarray, group: np.ndarray, p: np.ndarray, zero: np.ndarray, peers: int):
    """For each group of a block ``(group, peers after it, sums)`` over the terms that both hold.

    ``zero`` is the share of a term that the posting's group lacks. What the zero
    baselines of the two groups count for such a term is taken off here.
    """
    order = np.lexsort((group, term))
    term, group, p, zero = term[order], group[order], p[order], zero[order]
    stop = np.searchsorted(term, term, side="right")  # where the postings of a posting's term end
    rows = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.diff(group[rows])) + 1
    for mine in np.split(rows, edges):
        sums = np.zeros(peers, np.int64)
        lengths = stop[mine] - mine - 1
        done = np.concatenate([[0], np.cumsum(lengths)])
        first = 0
        while first < len(mine):
            last = max(first + 1, int(np.searchsorted(done, done[first] + STEP, side="right")) - 1)
            length = lengths[first:last]
            own = np.repeat(mine[first:last], length)
            at = own + 1 + np.arange(len(own)) - np.repeat(done[first:last] - done[first], length)
            both = distance(p[own], p[at]) - distance(p[own], zero[at]) - distance(zero[own], p[at])
            np.add.at(sums, group[at], both + distance(zero[own], zero[at]))
            first = last
        if len(mine):
            found = np.flatnonzero(sums)
            yield int(group[mine[0]]), found, sums[found]


def zero_sums(zero: int, shares: np.ndarray, often: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """For each peer, what a group's own terms add to the baseline if the peer lacks them all."""
    sums = np.zeros(len(zeros), np.int64)
    step = max(1, STEP // max(1, len(zeros)))
    for i in range(0, len(shares), step):
        apart = distance(shares[i : i + step, None], zeros[None, :]) - distance(np.int64(zero), zeros)[None, :]
        sums += (apart * often[i : i + step, None]).sum(axis=0)
    return sums


def _shared_terms(postings: DataFrame) -> DataFrame:
    """Rows ``(lang, u, v, value)`` of a block of terms: the sums of terms that both groups hold."""

    def run(key: tuple, block: pa.Table) -> pa.Table:
        term = block["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        group, p, zero = (block[c].to_numpy() for c in ("gid", "p", "zero"))
        parts = list(row_sums(term, group, p, zero, block["peers"][0].as_py()))
        u = np.concatenate([np.full(len(v), g, np.int64) for g, v, _ in parts])
        v = np.concatenate([v for _, v, _ in parts]).astype(np.int64)
        sums = np.concatenate([s for _, _, s in parts])
        return pa.table({"lang": pa.array([key[0].as_py()] * len(u), pa.string()), "u": u, "v": v, "value": sums})

    blocks = postings.select("lang", "block", "term", "gid", "p", "zero", "peers").groupBy("lang", "block")
    return blocks.applyInArrow(run, "lang string, u long, v long, value long")


def _baselines(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows ``(lang, u, v, value)``, two for a pair: all terms as if the groups had none in common.

    A row of ``groups`` meets the shares that occur in it (no more than its distinct
    counts) and its peers' baselines (one number a peer, as many as it has results).
    """
    often = postings.groupBy("lang", "gid", "p").agg(F.count("*").alias("n"))
    own = often.groupBy("lang", "gid").agg(F.collect_list(F.struct("p", "n")).alias("own"))
    zeros = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("gid", "zero"))).alias("zeros"))
    rows = groups.select("lang", "gid", "zero", "kept").join(own, ["lang", "gid"], "left").join(zeros, "lang")
    rows = rows.select("lang", "gid", "zero", "kept", F.col("own.p").alias("shares"), F.col("own.n").alias("often"),
                       F.col("zeros.zero").alias("zeros"))

    def make():
        def apply(gids, zero, kept, shares, often, zeros):
            sums = []
            for g, z, k, s, o, peers in zip(gids, zero, kept, shares, often, zeros, strict=True):
                peers = peers.values.to_numpy()
                found = [x.values.to_numpy() if x.is_valid else np.empty(0, np.int64) for x in (s, o)]
                row = zero_sums(z.as_py(), *found, peers)
                row[g.as_py() :] += k.as_py() * distance(np.int64(z.as_py()), peers[g.as_py() :])
                sums.append(row.tolist())
            return [pa.array(sums, pa.list_(pa.int64()))]

        return apply

    names = ["gid", "zero", "kept", "shares", "often", "zeros"]
    dense = arrow_columns(rows, names, "sums array<long>", make, keep=["lang", "gid"])
    peers = dense.select("lang", "gid", F.posexplode("sums").alias("peer", "value")).withColumn("peer", F.col("peer").cast("long"))
    apart = peers.filter(F.col("peer") != F.col("gid"))
    return apart.select("lang", F.least("gid", "peer").alias("u"), F.greatest("gid", "peer").alias("v"), "value")


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
          settings: Settings = Settings()) -> DataFrame:
    """Rows ``(lang, source, part, item, value, rank)`` for each group (language and source) of ``docs``.

    Part ``pair`` has every other source of the language with the distance of the two
    over all kept terms; part ``term`` the terms that the group has more of than its
    language, farthest first, ranks up to ``settings.top``. Ties go by the item's UTF-8.
    A language keeps the terms in at least ``min_docs`` of its rows; without any, its pairs
    are at distance 0. Null text, language and source count as empty; repeated rows count
    each; texts of any length are counted whole. Other columns are ignored; an empty table
    gives no rows. All sums are exact.
    """
    small_batches(docs.sparkSession)
    blank = F.lit("")
    own = docs.select(*(F.coalesce(F.col(f"`{c}`"), blank).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))
    sums = [F.sum("n").alias("n"), F.sum("docs").alias("docs")]
    counts = _counted(own).groupBy("lang", "source", "term").agg(*sums)
    of_term = Window.partitionBy("lang", "term")
    counts = counts.withColumns({
        "lang_n": F.sum("n").over(of_term), "lang_docs": F.sum("docs").over(of_term), "first": F.min("source").over(of_term) == F.col("source"),
    })
    counts = counts.filter(F.col("lang_docs") >= settings.min_docs)
    counts = materialize(counts.select("lang", "source", "term", "n", "lang_n", "first"), "divergence-counts")

    totals = counts.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count("*").alias("rows"), F.sum(F.col("first").cast("long")).alias("kept")
    )
    groups = own.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").na.fill(0, ["total", "rows", "kept"])
    of_lang = Window.partitionBy("lang")
    groups = groups.select(
        "lang", "source", "total",
        (F.row_number().over(of_lang.orderBy("source")) - 1).cast("long").alias("gid"),
        F.count("*").over(of_lang).alias("peers"),
        F.sum("total").over(of_lang).alias("lang_total"),
        F.sum("rows").over(of_lang).alias("lang_rows"),
        F.sum("kept").over(of_lang).alias("kept"),
    )
    zero = share("0", "total", "kept", settings.added)
    size = F.greatest(F.lit(BLOCK), F.col("peers") * BLOCK_PER_GROUP)
    groups = materialize(groups.withColumns({"zero": zero, "blocks": F.ceil(F.col("lang_rows") / size)}), "divergence-groups")
    few = groups.count() <= BROADCAST_GROUPS

    def with_group(left: DataFrame, names: list[str], *columns: str | Column) -> DataFrame:
        right = groups.select(*names, *columns)
        return left.join(F.broadcast(right) if few else right, names)

    known = with_group(counts, ["lang", "source"], "gid", "total", "lang_total", "kept", "zero", "peers", "blocks")
    known = known.withColumns({
        "p": share("n", "total", "kept", settings.added),
        "q": share("lang_n", "lang_total", "kept", settings.added),
        "block": F.pmod(F.xxhash64("term"), F.col("blocks")),
    })

    value = F.expr("(p - q) * (p - q) div (p + q)").alias("value")
    terms = known.filter(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value)
    of_group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = terms.withColumn("rank", F.row_number().over(of_group)).filter(F.col("rank") <= settings.top)

    found = _shared_terms(known).unionByName(_baselines(known, groups))
    pairs = found.groupBy("lang", "u", "v").agg(F.sum("value").alias("value"))
    way = F.explode(F.array(F.struct(F.col("u").alias("gid"), F.col("v").alias("peer")), F.struct(F.col("v").alias("gid"), F.col("u").alias("peer"))))
    pairs = pairs.select("lang", way.alias("way"), "value").select("lang", "way.gid", "way.peer", "value")
    pairs = with_group(pairs, ["lang", "gid"], "source")
    item = groups.select("lang", F.col("gid").alias("peer"), F.col("source").alias("item"))
    pairs = pairs.join(F.broadcast(item) if few else item, ["lang", "peer"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(of_group)).unionByName(terms)
