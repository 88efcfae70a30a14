"""License scans by MinHash bands over overlapping windows, in DataFrame functions only.

A template of m shingles belongs to the class L, the power of two from m on.
Windows of 2 L shingles start every L shingles, so every occurrence lies whole
in a window, and a window that contains 0.8 of a template has a Jaccard
similarity of at least 0.8 m / (2 L + 0.2 m) > 0.19 with it.  With one hash to
a band and ``BANDS`` bands such a window meets the template in some band with
probability 1 - 0.81^64 > 0.999998.  Retrieved windows are verified: the share
of the template's shingles that the window contains, compared as text.

A window can only meet a template where it holds the shingle that has the
template's least hash in some band.  Those shingles are few, so windows
without any of them are passed over before their hashes are computed; the
result is that of computing them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import store, texts

BANDS = 64
WORDS = 5
CONTAINMENT = 0.8
# Notices by the name of their license.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("All-rights-reserved", "All rights reserved."),
]


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    parts = F.split(F.lower(text), "[^\\p{L}\\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def shingles(words: Column, width: int) -> Column:
    """Space-joined runs of ``width`` words; none when there are fewer."""
    count = F.size(words) - (width - 1)
    starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: F.array_join(F.slice(words, at, width), " "))


def _hashes(words: Column, width: int) -> Column:
    """Hash of each shingle, in order, without building its text."""
    n = F.size(words)
    shifted = [F.slice(words, k + 1, F.greatest(n - k, F.lit(1))) for k in range(width)]
    zipped = F.slice(F.arrays_zip(*shifted), F.lit(1), F.greatest(n - (width - 1), F.lit(0)))
    return F.transform(zipped, lambda row: F.xxhash64(*[row[str(k)] for k in range(width)]))


def _least(hashes: Column) -> Column:
    """The least hash of each band."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda band: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band))))


def _band_shingles(hashes: Column) -> Column:
    """Distinct hashes that are the least of some band."""
    return F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda band: F.array_min(F.transform(
            hashes, lambda h: F.struct(F.xxhash64(h, band).alias("order"), h.alias("h"))))["h"]))


def template_table(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(template, license_id, width, size, shingles, bands, anchors): one row per template.

    Templates shorter than a shingle are one shingle of all their words.
    """
    rows = spark.createDataFrame(
        [(k, *row) for k, row in enumerate(templates)], "template int, license_id string, notice string")
    rows = rows.withColumn("words", words_of(F.col("notice"))).filter(F.size("words") > 0)
    parts = []
    for width in range(1, WORDS + 1):
        wide = F.size("words") == width if width < WORDS else F.size("words") >= width
        words = F.col("words")
        hashes = _hashes(words, width)
        parts.append(rows.filter(wide).select(
            "template", "license_id", F.lit(width).alias("width"),
            F.array_distinct(shingles(words, width)).alias("shingles"),
            _least(hashes).alias("bands"), _band_shingles(hashes).alias("anchors")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    size = F.pow(F.lit(2), F.ceil(F.log2(F.size("shingles").cast("double")))).cast("int")
    return out.withColumn("size", size)


def scan_licenses(docs: DataFrame, templates: DataFrame,
                  containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, license_id, windows, position, containment): licenses found in whole texts.

    ``position`` is the first word of the first best window, ``windows`` the
    number of windows that hold the notice.  Null and empty texts hold
    nothing; rows that repeat an id add up; null ids form one group; other
    columns of either table are not read.  No templates or documents give no
    rows.  ``templates`` is a bounded table and is broadcast.
    """
    shelf = store(templates, "templates")
    sizes = shelf.groupBy("width", "size").agg(
        F.array_distinct(F.flatten(F.collect_list("anchors"))).alias("anchors")).collect()
    worded = texts(docs).select("doc_id", words_of(F.col("text")).alias("words"))
    found = None
    for width in sorted({row.width for row in sizes}):
        anchors = {row["size"]: row.anchors for row in sizes if row.width == width}
        found_here = _matches(worded, shelf, width, anchors, containment)
        found = found_here if found is None else found.unionByName(found_here)
    if found is None:
        kind = docs.schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame(
            [], f"doc_id {kind}, license_id string, windows long, position int, containment double")
    best = F.max(F.struct("containment", (-F.col("position")).alias("before")))
    return found.groupBy("doc_id", "license_id").agg(
        F.countDistinct("size", "window").alias("windows"), best.alias("best")
    ).select("doc_id", "license_id", "windows",
             (-F.col("best.before")).cast("int").alias("position"), "best.containment")


def _windows(hits: Column, size: int, anchors: list[int]) -> Column:
    """Windows of one class around the places of its anchors."""
    near = F.filter(hits, lambda hit: hit["h"].isin(anchors))
    at = F.transform(near, lambda hit: F.floor(hit["at"] / size).cast("int"))
    both = F.array_distinct(F.concat(at, F.transform(at, lambda k: k - 1)))
    return F.transform(F.filter(both, lambda k: k >= 0),
                       lambda k: F.struct(F.lit(size).alias("size"), k.alias("window")))


def _matches(worded: DataFrame, shelf: DataFrame, width: int, anchors: dict[int, list[int]],
             containment: float) -> DataFrame:
    """Windows that contain a template of one shingle width, of all classes in one pass."""
    every = sorted({a for some in anchors.values() for a in some})
    places = F.transform("hashes", lambda h, at: F.struct(at.alias("at"), h.alias("h")))
    cut = (
        worded.withColumn("hashes", _hashes(F.col("words"), width))
        .withColumn("hits", F.filter(places, lambda hit: hit["h"].isin(every)))
        .select("doc_id", "words", "hashes", F.inline(F.concat(
            *[_windows(F.col("hits"), size, some) for size, some in sorted(anchors.items())])))
        .select("doc_id", "size", "window",
                F.slice("words", F.col("window") * F.col("size") + 1,
                        2 * F.col("size") + (width - 1)).alias("words"),
                F.slice("hashes", F.col("window") * F.col("size") + 1,
                        2 * F.col("size")).alias("hashes"))
    )
    banded = cut.select(
        "doc_id", "size", "window", "words", F.posexplode(_least(F.col("hashes"))).alias("band", "least"))
    keys = shelf.filter(F.col("width") == width).select(
        "template", "license_id", "size", "shingles", F.posexplode("bands").alias("band", "least"))
    share = F.size(F.array_intersect("shingles", shingles(F.col("words"), width))) / F.size("shingles")
    return (
        banded.join(F.broadcast(keys), ["size", "band", "least"])
        .dropDuplicates(["doc_id", "size", "window", "template", "words"])
        .select("doc_id", "license_id", "size", "window",
                (F.col("window") * F.col("size")).alias("position"), share.alias("containment"))
        .filter(F.col("containment") >= containment)
    )
