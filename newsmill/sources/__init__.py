"""Readers, normalisers and writers for landed data."""
