"""Homomorphic multiset fingerprints of documents, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sign lanes of a fingerprint, 64 from each hash.
LANES = 128
#: A paragraph's fragments: up to 48 code points that end earlier at a sentence's end or a line break.
FRAGMENT = r"[^\n.!?]{1,48}[.!?]*|[.!?]+"
_LOW = 0xFFFFFFFF
_SPREAD = (1 << 31) | 1
_FIRST = -(1 << 63)


def _hash(value: Column, seed: int) -> Column:
    return F.xxhash64(value, F.lit(seed))


def parts(text: Column) -> Column:
    """What is added up for a text: its paragraphs (lines) and their fragments, as (kind, piece)."""
    return F.concat(
        F.transform(F.split(text, "\n", -1), lambda p: F.struct(F.lit(0).alias("kind"), p.alias("piece"))),
        F.transform(
            F.regexp_extract_all(text, F.lit(FRAGMENT), 0),
            lambda p: F.struct(F.lit(1).alias("kind"), p.alias("piece")),
        ),
    )


def vector_sums(kind: Column, piece: Column) -> list[Column]:
    """Aggregates of a fingerprint: sums of wide vectors, so adding or removing a paragraph adds or
    subtracts its vector, and the order of paragraphs has no influence.

    ``e0`` to ``e3``: 32-bit words of two hashes of whole paragraphs, taken modulo 2^32 when shown; they
    tell texts apart. ``a``/``b`` 0 to 31: how many fragments have a hash bit set, two bits to a sum of 31
    bits each, which no text in one row can overflow; ``n``: fragments. A lane is 2 * bits - n, so that
    its products estimate how many fragments two texts share.
    """
    h1, h2 = _hash(piece, 1), _hash(piece, 2)
    whole, fragment = kind == 0, kind == 1
    zero = F.lit(0).cast("long")
    out = [
        F.sum(F.when(whole, F.shiftrightunsigned(h, s).bitwiseAND(F.lit(_LOW))).otherwise(zero)).alias(f"e{2 * i + s // 32}")
        for i, h in enumerate((h1, h2))
        for s in (0, 32)
    ]
    mask = F.lit(_SPREAD).cast("long")
    for name, h in (("a", h1), ("b", h2)):
        for bit in range(32):
            # bits `bit` and `bit + 31`
            shifted = F.shiftrightunsigned(h, bit)
            out.append(F.sum(F.when(fragment, shifted.bitwiseAND(mask)).otherwise(zero)).alias(f"{name}{bit}"))
    out.append(F.sum(F.when(fragment, F.lit(1).cast("long")).otherwise(zero)).alias("n"))
    return out


def _counts(prefix: str = "") -> list[Column]:
    """The counts of set bits, as many as there are lanes."""
    out = []
    for name in "ab":
        for bit in range(32):
            value = F.col(f"{prefix}{name}{bit}")
            out += [value.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftrightunsigned(value, 31)]
    return out


def lanes(prefix: str = "") -> Column:
    n = F.col(f"{prefix}n")
    return F.array(*[(2 * c - n).cast("int") for c in _counts(prefix)])


def shown(words: Column, lane: Column) -> Column:
    """Hex: four words modulo 2^32, then every lane modulo 2^16."""
    hexes = F.transform(words, lambda w: F.lpad(F.hex(w.bitwiseAND(F.lit(_LOW))), 8, "0"))
    tails = F.transform(lane, lambda v: F.lpad(F.hex(v.cast("long").bitwiseAND(F.lit(0xFFFF))), 4, "0"))
    return F.lower(F.concat(F.array_join(hexes, ""), F.array_join(tails, "")))


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def likeness(words_a: Column, a: Column, words_b: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the cosine of the lanes between 0 and 1: about the shared part of the fragments."""
    size = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    cosine = F.when(size > 0, _dot(a, b) / size).otherwise(0.0)
    return F.when((words_a == words_b) & (a == b), 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds are not above the key: a search in two steps over the sorted bounds."""
    step = math.isqrt(len(bounds)) + 1
    coarse = F.array(*[F.lit(b).cast("long") for b in bounds[::step]])
    fine = F.array(*[F.lit(b).cast("long") for b in bounds])
    upper = F.size(F.filter(coarse, lambda b: b <= key))
    begin = (F.greatest(upper, F.lit(1)) - 1) * step
    return (begin + F.size(F.filter(F.slice(fine, begin + 1, step), lambda b: b <= key))).cast("int")


def fingerprint_edits(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprint each text, an edited text, and compare with that and with the next document.

    The next document follows by ``doc_id`` (after the last: the first); the edited text has its last
    floor(n_chars / 2) code points replaced by the first as many (or all) of the next. Texts go through
    one shuffle, by ranges of ids: the first document of a range is also sent to the range before, so
    that every text meets its successor there, and fingerprints are added up in the same tasks.

    Null text is empty; null ids come first; rows of equal id are ordered by text. An empty table gives
    an empty result. ``buckets`` defaults to four for each shuffle partition.
    """
    spark = docs.sparkSession
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    count = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = own.agg(
        F.percentile_approx("key", [i / count for i in range(count)], F.lit(max(10_000, 4 * count))).alias("b")
    ).first()["b"]
    bounds = sorted(set(found or [0]))
    last = len(bounds)
    home = F.col("home")
    # the first key of a range is a bound itself
    at_start = F.element_at(F.array(*[F.lit(b).cast("long") for b in bounds]), home) == F.col("key")
    before = F.when(home == 1, F.lit(last)).otherwise(home - 1)
    sent = (
        own.withColumn("home", _bucket(F.col("key"), bounds))
        .withColumn(
            "to",
            F.explode(
                F.when(
                    at_start,
                    F.array(
                        F.struct(home.alias("bucket"), F.lit(False).alias("guest")),
                        F.struct(before.alias("bucket"), F.lit(True).alias("guest")),
                    ),
                ).otherwise(F.array(F.struct(home.alias("bucket"), F.lit(False).alias("guest"))))
            ),
        )
        .select("to.bucket", "to.guest", "doc_id", "key", "text")
    )
    order = Window.partitionBy("bucket").orderBy("guest", "key", "text")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next"), F.lit(1), half))
    pairs = sent.select(
        "*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next")
    ).select(
        "bucket", "guest", "place", "doc_id", F.length("text").cast("long").alias("n_chars"), "text",
        F.when(~F.col("guest"), edited).alias("edited"),
    )
    head = ("bucket", "place", "guest", "doc_id", "n_chars")
    sides = pairs.select(
        *head,
        F.when(~F.col("guest"), F.sha2(F.col("edited").cast("binary"), 256)).alias("edited_sha256"),
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("text").alias("t")),
                F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")),
            )
        ).alias("s"),
    ).where(F.col("s.t").isNotNull())
    pieces = sides.select(*head, "edited_sha256", "s.side", F.explode(parts(F.col("s.t"))).alias("v"))
    sums = pieces.groupBy(*head, "edited_sha256", "side").agg(*vector_sums(F.col("v.kind"), F.col("v.piece")))
    prints = sums.select(
        *head, "edited_sha256", "side", F.array("e0", "e1", "e2", "e3").alias("words"), lanes().alias("lanes")
    )
    # text, edited text, next text stand in order within a bucket
    following = Window.partitionBy("bucket").orderBy("place", "side")
    row = F.struct("words", "lanes")
    together = prints.select(
        *head, "edited_sha256", "side", "words", "lanes",
        F.lead(row, 1).over(following).alias("e"), F.lead(row, 2).over(following).alias("x"),
    ).where((F.col("side") == 0) & ~F.col("guest"))
    return together.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown(F.col("words"), F.col("lanes")).alias("fingerprint"),
        shown(F.col("e.words"), F.col("e.lanes")).alias("edited_fingerprint"),
        likeness(F.col("words"), F.col("lanes"), F.col("e.words"), F.col("e.lanes")).alias("near_edited"),
        likeness(F.col("words"), F.col("lanes"), F.col("x.words"), F.col("x.lanes")).alias("near_next"),
    )
