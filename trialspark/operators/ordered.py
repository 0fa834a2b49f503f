"""Order-dependent columns per key that survive a key with a large share of the rows.

A plain ``partitionBy(key)`` window sorts all rows of a key in one task. Here a first pass over a bounded
sample finds the keys that are too large for that and cuts each into pieces at sampled places of its own
order. The window runs per (key, piece); the few values that cross pieces (running counts, the last row
before, the first row after) come from one summary row per piece. Where the cuts fall doesn't matter to the
result, so neither the sample nor the number of tasks does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialspark.session import cut_lineage

#: Sampled rows per shuffle partition, and the most pieces of one key.
SAMPLE, MOST_PIECES = 400, 256


def with_pieces(df: DataFrame, key: str, ts: str, tie: str, pieces: int | None = None) -> DataFrame:
    """Add ``_b``: the piece of its key that a row belongs to, ascending in (ts, tie) order.

    A key gets about two pieces for each shuffle partition that its rows would fill; most keys stay
    whole. ``pieces`` stands for the number of shuffle partitions. Rows that are equal in key, time and
    tie stay together.
    """
    n = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = df.select(F.col(key).alias("_key"), F.struct(F.col(ts).alias("t"), F.col(tie).alias("i")).alias("_place"))
    total = df.count()
    share = min(1.0, SAMPLE * n / max(1, total))
    drawn = places.sample(share, 11).groupBy("_key").agg(F.sort_array(F.collect_list("_place")).alias("_sample"))
    mine = F.size("_sample")
    wanted = F.least(F.ceil(2 * mine / F.lit(max(1.0, share * total / n))), F.lit(MOST_PIECES)).cast("int")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("_wanted") - 1), lambda k: F.get("_sample", F.floor(k * mine / F.col("_wanted")).cast("int"))
    )
    large = drawn.withColumn("_wanted", wanted).filter("_wanted > 2").select("_key", cuts.alias("_cuts"))
    # written, so that every branch of the plan cuts at the same places; at most some hundred keys are large
    large = cut_lineage(large)
    place = F.struct(F.col(ts).alias("t"), F.col(tie).alias("i"))
    found = df.join(large, df[key].eqNullSafe(large["_key"]), "left").drop("_key")
    piece = F.when(F.col("_cuts").isNull(), 0).otherwise(F.size(F.filter("_cuts", lambda c: c <= place)))
    return found.withColumn("_b", piece).drop("_cuts")


def _with_summary(df: DataFrame, summary: DataFrame, key: str) -> DataFrame:
    """Join on (key, piece); a null key is a key."""
    renamed = summary.withColumnsRenamed({key: "_key", "_b": "_piece"})
    same = df[key].eqNullSafe(renamed["_key"]) & (df["_b"] == renamed["_piece"])
    return df.join(renamed, same).drop("_key", "_piece")


def number_and_neighbours(
    df: DataFrame, key: str, ts: str, tie: str, payload: Column, pieces: int | None = None
) -> DataFrame:
    """Add ``seq`` (1-based), ``prev_payload`` and ``next_ts`` in (ts, tie) order within the key."""
    df = with_pieces(df, key, ts, tie, pieces).withColumn("_p", payload)
    local = Window.partitionBy(key, "_b").orderBy(ts, tie)
    placed = df.withColumns(
        {
            "_rn": F.row_number().over(local),
            "_lag": F.lag("_p").over(local),
            "_lead": F.lead(ts).over(local),
            "_n": F.count("*").over(Window.partitionBy(key, "_b")),
        }
    )
    along = Window.partitionBy(key).orderBy("_b")
    # the first and last rows of each piece, whose payload crosses to its neighbours
    summary = (
        placed.filter((F.col("_rn") == 1) | (F.col("_rn") == F.col("_n")))
        .groupBy(key, "_b")
        .agg(
            F.max("_n").alias("_size"),
            F.min(ts).alias("_first"),
            F.max_by("_p", "_rn").alias("_last"),
        )
        .select(
            key,
            "_b",
            F.coalesce(F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.lag("_last").over(along).alias("_prev"),
            F.lead("_first").over(along).alias("_next"),
        )
    )
    return (
        _with_summary(placed, summary, key)
        .withColumns(
            {
                "seq": F.col("_before") + F.col("_rn"),
                "prev_payload": F.when(F.col("_rn") == 1, F.col("_prev")).otherwise(F.col("_lag")),
                "next_ts": F.when(F.col("_rn") == F.col("_n"), F.col("_next")).otherwise(F.col("_lead")),
            }
        )
        .drop("_b", "_p", "_rn", "_lag", "_lead", "_n", "_before", "_prev", "_next")
    )


def carry_forward(df: DataFrame, key: str, ts: str, tie: str, value: str, pieces: int | None = None) -> DataFrame:
    """Replace ``value`` by its last non-null value up to and including the row, in (ts, tie) order."""
    df = with_pieces(df, key, ts, tie, pieces)
    local = Window.partitionBy(key, "_b").orderBy(ts, tie)
    placed = df.withColumns(
        {
            "_here": F.last(value, ignorenulls=True).over(local.rowsBetween(Window.unboundedPreceding, 0)),
            "_is_last": F.lead(F.lit(True)).over(local).isNull(),
        }
    )
    along = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        placed.filter("_is_last")
        .select(key, "_b", F.last("_here", ignorenulls=True).over(along).alias("_carried"))
    )
    return (
        _with_summary(placed, summary, key)
        .withColumn(value, F.coalesce("_here", "_carried"))
        .drop("_b", "_here", "_is_last", "_carried")
    )


def exact_percentile(df: DataFrame, value: str, p: float, by: str | None = None, pieces: int | None = None) -> DataFrame:
    """The exact percentile of ``value`` for each ``by`` (one row without it): ``p`` from 0 to 1, interpolated.

    Values are counted once per distinct value. Groups with very many distinct values are cut into pieces in
    value order; the counts of the pieces tell which of them holds the rank, and only its values are ordered.
    Returns ``by``, ``percentile`` and ``n``. Nulls don't count; a group without values has no row.
    """
    key = by or "_all"
    rows = df.select((F.col(by) if by else F.lit(0)).alias(key), F.col(value).cast("double").alias("_v")).filter("_v is not null")
    counts = cut_lineage(rows.groupBy(key, "_v").agg(F.count("*").alias("_n")))
    placed = with_pieces(counts, key, "_v", "_v", pieces)
    along = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(key, "_b").agg(F.sum("_n").alias("_m")).withColumns(
        {
            "_before": F.coalesce(F.sum("_m").over(along), F.lit(0)),
            "_total": F.sum("_m").over(Window.partitionBy(key)),
        }
    )
    place = F.lit(p) * (F.col("_total") - 1)
    low, high = F.floor(place), F.ceil(place)
    inside = lambda rank: (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_m"))
    holding = sums.filter(inside(low) | inside(high))
    order = Window.partitionBy(key, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    till = F.col("_before") + F.sum("_n").over(order)
    found = _with_summary(placed, holding, key).withColumn("_till", till)
    at = lambda rank: F.max(F.when((rank < F.col("_till")) & (rank >= F.col("_till") - F.col("_n")), F.col("_v")))
    values = found.groupBy(key).agg(at(low).alias("_low"), at(high).alias("_high"), F.max("_total").alias("n"))
    share = F.lit(p) * (F.col("n") - 1) - F.floor(F.lit(p) * (F.col("n") - 1))
    result = values.select(key, (F.col("_low") + (F.col("_high") - F.col("_low")) * share).alias("percentile"), "n")
    return result if by else result.drop(key)
