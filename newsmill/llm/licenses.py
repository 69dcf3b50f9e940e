"""License notices in texts: MinHash bands over overlapping windows, then exact containment.

A template is the set of its distinct word shingles. Texts are cut into windows of
four blocks of shingles, one block apart, with a block size that suits the
template: any run as long as the template lies within one window. The least of
each of 32 hashes over a window is a band of one row; a window retrieves the
templates that share a band. A window that holds the required part of a template
has a similarity of 1/4 with it at least, so a template is missed with a chance of
``(3/4) ** 32``, 1e-4, at most, and where several windows hold it, of less. What is
retrieved is verified: enough of the template's shingles must lie in the window, and
enough of those that tell it from each similar template of another license, such as
the words of its version.

A band can only be shared if the template's own least shingle is in the window, so
texts and windows without any of those are left out first, which changes no result.

All of it is built-in expressions over arrays.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.functions.binding import once
from newsmill.llm.decontaminate import word_hashes

# The usual wording of license notices.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": ("This work is licensed under the Creative Commons Attribution 4.0 International License.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
# End of fixed values.


@dataclass(frozen=True)
class Settings:
    """Words of a shingle, least part of a template's shingles in per cent, bands.

    Templates of two licenses are rivals if ``rival`` per cent of the one's shingles are the
    other's too; half of the shingles that a rival lacks must be found as well.
    Windows have ``blocks`` blocks and start a block apart; the block size is the
    least power of two that lets a template fit into all but one block.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    blocks: int = 4
    rival: int = 50


def _shingles(text: Column, size: int) -> Column:
    """Hashes of all shingles in order; a shorter text is one shingle, an empty one none."""

    def of(words: Column) -> Column:
        count = F.size(words) - (size - 1)
        runs = F.transform(
            F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(size)))
        )
        whole = F.array(F.aggregate(words, F.lit(7).cast("bigint"), lambda h, w: F.xxhash64(h, w)))
        none = F.array().cast("array<bigint>")
        return F.when(count > 0, runs).when(F.size(words) > 0, whole).otherwise(none)

    return once(word_hashes(text), of)


def _hash(shingle: Column, band: int) -> Column:
    return F.xxhash64(shingle, F.lit(band))


@dataclass(frozen=True)
class Template:
    license: str
    number: int
    shingles: tuple[int, ...]
    block: int
    minima: tuple[int, ...]
    """The least hash of each band."""
    least: frozenset[int]
    """The shingles they belong to."""


def prepare(spark: SparkSession, templates: Mapping[str, tuple[str, ...]], settings: Settings) -> list[Template]:
    """Shingles, block sizes and band minima of a catalogue of templates (a parameter, so small)."""
    texts = [(name, i, text) for name, group in templates.items() for i, text in enumerate(group)]
    rows = spark.createDataFrame(texts, "license string, number int, text string")
    hashed = rows.select("license", "number", F.array_distinct(_shingles(F.col("text"), settings.shingle)).alias("s"))
    least = [
        F.array_min(F.transform("s", _with_hash(i))) for i in range(settings.bands)
    ]
    out = []
    for r in hashed.filter(F.size("s") > 0).select("*", F.array(*least).alias("least")).collect():
        block = 1
        while len(r.s) > (settings.blocks - 1) * block:
            block *= 2
        minima = tuple(x.hash for x in r.least)
        out.append(Template(r.license, r.number, tuple(r.s), block, minima, frozenset(x.shingle for x in r.least)))
    return out


def rivals(known: list[Template], settings: Settings) -> list[list[list[int]]]:
    """For each template, the shingles that each of its rivals lacks."""
    sets = [set(t.shingles) for t in known]
    return [
        [[s for s in t.shingles if s not in b] for other, b in zip(known, sets, strict=True)
         if other.license != t.license and 100 * len(a & b) >= settings.rival * len(a)]
        for t, a in zip(known, sets, strict=True)
    ]


def _with_hash(band: int):
    return lambda s: F.struct(_hash(s, band).alias("hash"), s.alias("shingle"))


def _is_any(value: Column, values: list[int]) -> Column:
    return value.isin(*values) if values else F.lit(False)


def _windows(shingles: Column, block: int) -> Column:
    """Places of the first shingles of the windows, a block apart."""
    last = F.greatest(F.size(shingles) - block, F.lit(0))
    return F.sequence(F.lit(0), last, F.lit(block))


def scan(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
         templates: Mapping[str, tuple[str, ...]] = TEMPLATES, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs`` and license found: key, ``license``, ``first_word`` and ``containment``.

    ``containment`` is the largest part of a template that a window holds, and
    ``first_word`` the place where the first shingle of it begins (of equal parts
    the first). Null, empty and unlicensed texts give no row; rows that repeat a
    key and license give the best of them.
    """
    known = prepare(spark, templates, settings)
    least = sorted({s for t in known for s in t.least})
    own = docs.select(F.col(f"`{key}`").alias("key"), _shingles(F.col(f"`{text}`"), settings.shingle).alias("s"))
    own = own.filter(F.exists("s", lambda s: _is_any(s, least)))
    size = settings.blocks

    def per_block(block: int, group: list[Template]) -> Column:
        bands = [sorted({t.minima[i] for t in group}) for i in range(settings.bands)]

        def shared(inside: Column, band: int) -> Column:
            """The window's minimum, if it is one of a template's."""
            minimum = F.array_min(F.transform(inside, lambda s: _hash(s, band)))
            return once(minimum, lambda m: F.when(_is_any(m, bands[band]), m))

        def window(start: Column) -> Column:
            def rows(inside: Column) -> Column:
                both = F.array_compact(F.array(*(shared(inside, i) for i in range(settings.bands))))
                return F.struct(
                    start.alias("first_word"), F.lit(block).alias("block"), both.alias("bands"),
                    inside.alias("inside"),
                )

            return once(F.slice(F.col("s"), start + 1, F.lit(size * block)), rows)

        # Windows without any template minimum share no band.
        starts = F.filter(
            _windows(F.col("s"), block),
            lambda i: F.exists(F.slice(F.col("s"), i + 1, F.lit(size * block)), lambda s: _is_any(s, least)),
        )
        return F.filter(F.transform(starts, window), lambda w: F.size(w["bands"]) > 0)

    groups: dict[int, list[Template]] = {}
    for t in known:
        groups.setdefault(t.block, []).append(t)
    if not groups:
        return docs.select(F.col(f"`{key}`").alias(key), F.lit("").alias("license"), F.lit(0).alias("first_word"),
                           F.lit(0.0).alias("containment")).limit(0)
    windows = own.select("key", F.explode(F.concat(*(per_block(b, g) for b, g in sorted(groups.items())))).alias("w"))
    windows = windows.select("key", "w.*")
    bands = [(i, t.block, m) for i, t in enumerate(known) for m in set(t.minima)]
    lookup = spark.createDataFrame(bands, "template int, block int, band long")
    apart = rivals(known, settings)
    names = spark.createDataFrame(
        [(i, t.license, list(t.shingles), apart[i]) for i, t in enumerate(known)],
        "template int, license string, shingles array<long>, apart array<array<long>>",
    )
    # Both tables are the catalogue of templates, which is a literal parameter.
    hits = windows.select("key", "first_word", "block", "inside", F.explode("bands").alias("band"))
    hits = hits.join(F.broadcast(lookup), ["block", "band"]).groupBy("key", "first_word", "template")
    hits = hits.agg(F.first("inside").alias("inside")).join(F.broadcast(names), "template")
    common = F.size(F.array_intersect("inside", "shingles"))
    found = hits.withColumn("common", common).filter(F.col("common") * 100 >= F.size("shingles") * settings.percent)
    found = found.filter(F.forall("apart", lambda own: F.size(F.array_intersect("inside", own)) * 2 >= F.size(own)))
    places = F.filter(F.sequence(F.lit(0), F.size("inside") - 1), lambda i: F.array_contains("shingles", F.get("inside", i)))
    found = found.withColumn("first_word", F.col("first_word") + F.get(places, F.lit(0)))
    best = found.groupBy("key", "license").agg(
        F.max(F.struct((F.col("common") / F.size("shingles")).alias("part"), (-F.col("first_word")).alias("place"))).alias("b")
    )
    return best.select(
        F.col("key").alias(key), "license", (-F.col("b.place")).alias("first_word"), F.col("b.part").alias("containment")
    )
