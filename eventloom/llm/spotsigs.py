"""SpotSigs document fingerprints, in DataFrame functions only.

A signature is an anchor, a run of common words, with the chain of the next
content words.  A text's fingerprint stands for its set of signatures, and the
likeness of two fingerprints is the Jaccard similarity of the sets.  Near
pairs are found in partitions by set length: sets whose lengths differ too
much for the threshold never meet, and within them rare signatures come first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import store, texts
from eventloom.llm.setjoin import candidates, postings, verified, with_identity

# Anchors: common words of the corpus languages.
ANCHORS = (
    "a", "an", "the", "of", "and", "to", "in", "is", "was", "be", "that", "it", "for", "on", "with",
    "der", "die", "das", "und", "von", "zu", "den", "dem", "ein", "eine", "ist", "mit",
    "le", "la", "les", "de", "et", "un", "une", "est", "en", "du", "des", "que",
    "el", "los", "las", "del", "y", "una", "por", "se", "es",
)
CHAIN = 2
THRESHOLD = 0.8
# Documents per slice of the id order, and most slices.
_SLICE_DOCS = 512
_MOST_SLICES = 16384
_MARK = "\u0001"


def signatures(text: Column, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> Column:
    """Sorted distinct signature hashes of a text.

    Anchors are hung on the content word before them, so that the rest is the
    sequence of content words.  A text with words but no anchor before a
    content word has one signature, its whole sequence of words; an empty text
    has none.
    """
    blank = F.translate(F.lower(text), f"{_MARK}\t\n\x0b\f\r", " " * 6)
    flat = F.trim(F.regexp_replace(blank, " {2,}", " "))
    hung = F.array_join(F.transform(
        F.split(flat, " "),
        lambda w: F.concat(F.when(w.isin(*anchors), _MARK).otherwise(" "), w)), "")

    parts = F.split(hung, " ")
    n = F.size(parts)
    zipped = F.arrays_zip(
        parts, *[F.slice(parts, k + 1, F.greatest(n - k, F.lit(1))) for k in range(1, chain + 1)])

    def word(part: Column) -> Column:
        return F.substring_index(part, _MARK, 1)

    def chained(row: Column) -> Column:
        following = [word(row[str(k)]) for k in range(1, chain + 1)]
        opens = (F.locate(_MARK, row["0"]) > 0) & row["1"].isNotNull()
        at = F.locate(_MARK, row["0"])
        anchor = F.substring(row["0"], at + 1, F.length(row["0"]))
        return F.when(opens, F.xxhash64(anchor, *following))

    found = F.filter(F.transform(zipped, chained), lambda s: s.isNotNull())
    whole = F.when(flat == "", F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(flat)))
    return F.transform(
        F.array(F.array_sort(F.array_distinct(found))),
        lambda s: F.when(F.size(s) > 0, s).otherwise(whole))[0]


def label(signs: Column) -> Column:
    """The fingerprint of a signature set: its length and 128 bits of its elements."""
    high = F.lower(F.lpad(F.hex(F.xxhash64(signs)), 16, "0"))
    low = F.lower(F.lpad(F.hex(F.xxhash64(F.lit(1), signs)), 16, "0"))
    return F.concat(F.size(signs).cast("string"), F.lit(":"), high, low)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity; two empty sets are alike."""
    n, m = F.size(a), F.size(b)
    common = F.size(F.array_intersect(a, b))
    return (
        F.when((n == 0) & (m == 0), F.lit(1.0))
        .when((n == 0) | (m == 0), F.lit(0.0))
        .otherwise(common / (n + m - common))
    )


def _slice_of(bounds: list[int]) -> Column:
    """How many of the sorted bounds are not above the id, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]

    def move(low: Column, step: Column) -> Column:
        onward = F.coalesce(F.get(table, low + step - 1) <= F.col("doc_id"), F.lit(False))
        return F.when(onward, low + step).otherwise(low)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), move)


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text): the document that follows in descending ``doc_id``.

    After the last comes the first.  Ids are cut at quantiles into slices of
    some hundred documents, each ordered by itself; the first document of the
    slice that follows is added to each as a guest.
    """
    whole = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    n = whole.count()
    slices = max(1, min(_MOST_SLICES, math.ceil(n / _SLICE_DOCS)))
    bounds: list[int] = []
    if slices > 1:
        shares = [k / slices for k in range(1, slices)]
        found = whole.agg(F.percentile_approx("doc_id", shares, 20_000)).first()[0]
        bounds = sorted(set(found or []))
    sliced = whole.withColumn("slice", _slice_of(bounds))
    tops = sliced.groupBy("slice").agg(F.max("doc_id").alias("top"))
    order = Window.orderBy("slice")
    needs = tops.select(
        "slice",
        F.coalesce(F.lag("top").over(order),
                   F.max("top").over(order.rowsBetween(Window.unboundedPreceding,
                                                       Window.unboundedFollowing))).alias("top"))
    # At most one row per slice, so the broadcast is bounded.
    guests = whole.join(F.broadcast(needs), F.col("doc_id").eqNullSafe(F.col("top"))).select(
        "doc_id", "text", "slice", F.lit(True).alias("guest"))
    along = Window.partitionBy("slice").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("text"))
    return (
        sliced.withColumn("guest", F.lit(False)).unionByName(guests)
        .withColumn("next_text", F.lead("text").over(along))
    )


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and likenesses.

    The edited text has the last half of the code points replaced by the first
    as many, or all, of the next document.  Null texts count as empty; a null
    ``doc_id`` comes last in the order, rows that repeat an id follow each
    other by text; a single document is its own next.  Only the two named
    columns are read.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.col("n_chars").cast("int") - half
    along = Window.partitionBy("slice").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("text"))
    edited = (
        with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn("edited", F.concat(
            F.substring("text", F.lit(1), kept),
            F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)))
        .withColumn("signs", signatures(F.col("text")))
        .withColumn("next_signs", F.lead("signs").over(along))
        .filter(~F.col("guest"))
        .select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "signs",
                "next_signs", signatures(F.col("edited")).alias("edited_signs"))
    )
    return edited.select(
        "doc_id", "n_chars", "edited_sha256", label(F.col("signs")).alias("fingerprint"),
        label(F.col("edited_signs")).alias("edited_fingerprint"),
        likeness(F.col("signs"), F.col("edited_signs")).alias("near_edited"),
        likeness(F.col("signs"), F.col("next_signs")).alias("near_next"),
    )


def _length_class(n: Column, threshold: float) -> Column:
    return F.floor(F.log(n.cast("double")) / F.lit(-math.log(threshold))).cast("int")


def near_pairs(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(fingerprint_a, fingerprint_b, similarity): pairs of different signature sets.

    Lengths are cut into classes as wide as the threshold allows, so a set
    meets only its own class and, as a guest, the class below.  Documents with
    equal fingerprints are one set; empty sets pair with nothing.
    """
    sets = store(
        with_identity(texts(docs).select(signatures(F.col("text")).alias("keys")))
        .filter("n > 0").dropDuplicates(["sig"]), "signatures")
    own = _length_class(F.col("n"), threshold)
    rows = postings(sets, threshold).withColumn(
        "part", F.explode(F.array(own, own - 1))).withColumn("key", F.xxhash64("key", "part"))
    pairs = store(candidates(rows.drop("part"), threshold), "pairs")
    near = verified(pairs, sets, threshold)
    for side in "ab":
        near = near.join(sets.select(
            F.col("sig").alias(side), label(F.col("keys")).alias(f"label_{side}")), side)
    return near.select(
        F.least("label_a", "label_b").alias("fingerprint_a"),
        F.greatest("label_a", "label_b").alias("fingerprint_b"), "similarity")
