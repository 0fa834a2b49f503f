"""Versions of a record: numbering, validity intervals, changes, and as-of lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType
from pyspark.sql.window import Window

from trialspark.operators.ordered import carry_forward, number_and_neighbours


def build_scd2(
    df: DataFrame, key: str, ts: str, tracked: list[str], tie: str, pieces: int | None = None
) -> DataFrame:
    """Version number, ``[valid_from, valid_to)``, ``is_current`` and changed fields per row.

    ``changed_fields`` maps a field to its old and new value as text; the first version has none.
    """
    placed = number_and_neighbours(df, key, ts, tie, F.struct(*tracked), pieces)
    pairs = F.create_map(
        *[
            part
            for c in tracked
            for part in (
                F.lit(c),
                F.struct(
                    F.col(f"prev_payload.{c}").cast("string").alias("old"), F.col(c).cast("string").alias("new")
                ),
            )
        ]
    )
    changed = F.map_filter(pairs, lambda _, v: ~v["old"].eqNullSafe(v["new"]))
    no_change = F.map_filter(pairs, lambda _, __: F.lit(False))
    return placed.withColumns(
        {
            "version_number": F.col("seq"),
            "valid_from": F.col(ts),
            "valid_to": F.col("next_ts"),
            "is_current": F.col("next_ts").isNull(),
            "changed_fields": F.when(F.col("prev_payload").isNull(), no_change).otherwise(changed),
        }
    ).drop("seq", "prev_payload", "next_ts")


def as_of(
    versions: DataFrame, lookups: DataFrame, key: str, ts: str, lookup_id: str, pieces: int | None = None
) -> DataFrame:
    """The version valid at each lookup time: ``valid_from <= ts < valid_to`` (null = open).

    Versions and lookups are merged in time order and the last version is carried forward, which is
    linear in both; an equi-join on the key would pair every lookup with every version of it.
    Intervals of one key do not overlap. ``lookup_id`` has any type that can be ordered.
    """
    fields = [c for c in versions.columns if c != key]
    # of versions that start together the longest one, valid when the others have ended, comes last
    until = F.coalesce(F.unix_micros(F.col("valid_to").cast("timestamp")), F.lit(2**63 - 1).cast("bigint"))
    id_type = dict(lookups.dtypes)[lookup_id]
    events = versions.select(
        F.col(key),
        F.col("valid_from").alias(ts),
        F.struct(F.lit(0).alias("kind"), until.alias("until"), F.lit(None).cast(id_type).alias("id")).alias("_tie"),
        F.struct(*fields).alias("_version"),
        F.lit(None).cast(id_type).alias(lookup_id),
    ).unionByName(
        lookups.select(
            F.col(key),
            F.col(ts),
            F.struct(F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("until"), F.col(lookup_id).alias("id")).alias("_tie"),
            F.lit(None).cast(versions.select(F.struct(*fields).alias("v")).schema["v"].dataType).alias("_version"),
            F.col(lookup_id),
        )
    )
    filled = carry_forward(events, key, ts, "_tie", "_version", pieces).filter(F.col("_tie.kind") == 1)
    open_or_later = F.col("_version.valid_to").isNull() | (F.col(ts) < F.col("_version.valid_to"))
    return filled.filter(F.col("_version").isNotNull() & open_or_later).select(
        lookup_id, key, ts, *[F.col(f"_version.{c}").alias(c) for c in fields]
    )


def first_request(df: DataFrame, key: str = "idempotency_key", ts: str = "requested_at", tie: str | None = None) -> DataFrame:
    """The earliest row per idempotency key; ``tie``, or else the other columns, decide equal times.

    Each task keeps one row per key before the shuffle.
    """
    rest = [tie] if tie else [f.name for f in df.schema if f.name not in (key, ts) and not isinstance(f.dataType, MapType)]
    order = Window.partitionBy(key).orderBy(ts, *rest)
    return df.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def rolling_metrics(df: DataFrame, ts: str, value: str, by: str, days: int = 30) -> DataFrame:
    """Trailing window per day and group, over daily sums: at most one row per day and group."""
    daily = df.groupBy(by, F.to_date(ts).alias("day")).agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), F.max(value).alias("peak")
    )
    number = F.unix_date("day")
    window = Window.partitionBy(by).orderBy(number).rangeBetween(-(days - 1), 0)
    return daily.select(
        by,
        "day",
        F.sum("n").over(window).alias("rolling_count"),
        (F.sum("total").over(window) / F.sum("n").over(window)).alias("rolling_avg"),
        F.max("peak").over(window).alias("rolling_max"),
    )
