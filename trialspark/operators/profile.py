"""Field, list-size, record-size and JSON-structure statistics."""

from __future__ import annotations

import json
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from trialspark.session import cut_lineage


def _long(df: DataFrame, id_col: str, fields: Iterable[str]) -> DataFrame:
    fields = list(fields)
    text = df.select(F.col(id_col).cast("string").alias("_id"), *[F.col(f).cast("string").alias(f) for f in fields])
    return text.unpivot(["_id"], fields, "field", "value")


def value_statistics(df: DataFrame, id_col: str, fields: Iterable[str], top: int = 10) -> DataFrame:
    """Missing, distinct and most common values, and the longest value with its smallest owner.

    Rows are counted once per (field, value), map-side and by hashing; the counts are written and everything
    else works on them. Only rows that hold a longest value are looked at again, for their owner.
    """
    rows = _long(df, id_col, fields)
    counts = cut_lineage(rows.groupBy("field", "value").agg(F.count("*").alias("n")))
    known = counts.filter(F.col("value").isNotNull())
    by_length = Window.partitionBy("field").orderBy(F.desc(F.length("value")), F.asc("value"))
    longest = cut_lineage(known.withColumn("_r", F.row_number().over(by_length)).filter("_r = 1").select("field", "value"))
    owners = rows.join(longest, ["field", "value"]).groupBy("field", "value").agg(F.min("_id").alias("owner"))
    summary = counts.groupBy("field").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing_count"),
        F.count("value").alias("unique_values"),
    )
    best = top_per_group(known, "field", "value", "n", top, "top_values")
    return summary.join(owners, "field", "left").join(best, "field", "left").select(
        "field",
        "missing_count",
        "unique_values",
        F.col("value").alias("longest_value"),
        F.length("value").alias("longest_length"),
        F.col("owner").alias("longest_owner"),
        "top_values",
    )


def top_per_group(counts: DataFrame, group: str, value: str, n: str, top: int, alias: str) -> DataFrame:
    """The most common values per group as a sorted array; Spark trims each task to ``top`` first."""
    order = Window.partitionBy(group).orderBy(F.desc(n), F.asc(value))
    ranked = counts.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= top)
    return ranked.groupBy(group).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_r", value, n))),
            lambda e: F.struct(e[value].alias("value"), e[n].alias("count")),
        ).alias(alias)
    )


def number_statistics(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """min, max, mean and missing per numeric field, from one aggregate row."""
    fields = list(fields)
    stats = [
        F.struct(
            F.lit(f).alias("field"),
            F.min(f).cast("double").alias("min_value"),
            F.max(f).cast("double").alias("max_value"),
            F.avg(f).alias("avg_value"),
            F.count_if(F.col(f).isNull()).alias("missing_count"),
        )
        for f in fields
    ]
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def date_statistics(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """min, max, missing and the formats seen, for date fields kept as text."""
    fields = list(fields)
    shape = lambda c: (
        F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), "yyyy-MM-dd")
        .when(c.rlike(r"^\d{4}-\d{2}$"), "yyyy-MM")
        .when(c.rlike(r"^\d{4}$"), "yyyy")
        .when(c.isNotNull(), "other")
    )
    stats = [
        F.struct(
            F.lit(f).alias("field"),
            F.min(f).alias("min_value"),
            F.max(f).alias("max_value"),
            F.count_if(F.col(f).isNull()).alias("missing_count"),
            F.array_sort(F.collect_set(shape(F.col(f)))).alias("formats"),
        )
        for f in fields
    ]
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def boolean_statistics(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    fields = list(fields)
    stats = [
        F.struct(
            F.lit(f).alias("field"),
            F.count_if(F.col(f)).alias("true_count"),
            F.count_if(~F.col(f)).alias("false_count"),
            F.count_if(F.col(f).isNull()).alias("missing_count"),
        )
        for f in fields
    ]
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def list_size_statistics(df: DataFrame, fields: Iterable[str], top: int = 10) -> DataFrame:
    """min, max, distinct and most common sizes of list fields; empty lists count, null ones do not."""
    fields = list(fields)
    sizes = df.select(*[F.array_size(f).alias(f) for f in fields]).unpivot([], fields, "field", "size")
    counts = sizes.filter(F.col("size").isNotNull()).groupBy("field", "size").agg(F.count("*").alias("n"))
    summary = counts.groupBy("field").agg(
        F.min("size").alias("min_size"), F.max("size").alias("max_size"), F.count("*").alias("unique_sizes")
    )
    return summary.join(top_per_group(counts, "field", "size", "n", top, "top_sizes"), "field")


# upper bounds in bytes of the reported size ranges
SIZE_RANGES = ((10_240, "0-10KB"), (25_600, "10-25KB"), (51_200, "25-50KB"), (102_400, "50-100KB"))


def size_range(size: Column) -> Column:
    out = F.when(size < SIZE_RANGES[0][0], SIZE_RANGES[0][1])
    for bound, label in SIZE_RANGES[1:]:
        out = out.when(size < bound, label)
    return out.otherwise("100KB+")


def record_size_statistics(df: DataFrame, json_col: str, points=(0.5, 0.75, 0.9, 0.95)) -> DataFrame:
    """Mean, exact percentiles and total, computed on counts per distinct size."""
    counts = df.groupBy(F.octet_length(json_col).alias("size")).agg(F.count("*").alias("n"))
    return counts.agg(
        F.sum("n").alias("total_records"),
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("average_bytes"),
        F.percentile("size", list(points), F.col("n")).alias("_p"),
    ).select(
        "total_records",
        "average_bytes",
        *[F.get("_p", F.lit(i)).alias(f"p{round(p * 100)}") for i, p in enumerate(points)],
    )


def record_size_ranges(df: DataFrame, json_col: str) -> DataFrame:
    return df.groupBy(size_range(F.octet_length(json_col)).alias("size_range")).agg(
        F.count("*").alias("records")
    )


def largest_records(df: DataFrame, id_col: str, json_col: str, n: int) -> DataFrame:
    sized = df.select(id_col, F.octet_length(json_col).alias("size_bytes"))
    return sized.orderBy(F.desc("size_bytes"), F.asc(id_col)).limit(n)


def top_level_keys(df: DataFrame, json_col: str) -> DataFrame:
    """How many records have each top-level key, and their share of the readable records."""
    keys = df.select(F.json_object_keys(json_col).alias("k")).filter(F.col("k").isNotNull())
    total = keys.agg(F.count("*").alias("n")).scalar()
    counted = keys.select(F.explode("k").alias("key")).groupBy("key").agg(F.count("*").alias("records"))
    return counted.withColumn("percentage", F.col("records") / total * 100)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _paths_of(texts: pd.Series) -> pd.Series:
    """Dotted paths of all object keys; a list is represented by its first element, as ``[0]``."""

    def paths(text: str | None) -> list[str] | None:
        try:
            pending = [("", json.loads(text))]
        except (TypeError, ValueError):
            return None
        found = set()
        while pending:
            prefix, value = pending.pop()
            if isinstance(value, list):
                pending.extend((f"{prefix}[0]", item) for item in value[:1])
            elif isinstance(value, dict):
                for key, inner in value.items():
                    path = f"{prefix}.{key}" if prefix else key
                    found.add(path)
                    pending.append((path, inner))
        return sorted(found)

    return texts.map(paths, na_action=None)


def json_key_paths(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, paths) with paths null for unreadable text. JSON nesting has no native walk."""
    return df.select(id_col, _paths_of(F.col(json_col)).alias("paths"))


def missing_paths(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    """(paths of b missing in a, paths of a missing in b)."""
    return F.array_except(b, a), F.array_except(a, b)


def compare_snapshots(local: DataFrame, fetched: DataFrame, key: str, json_col: str) -> DataFrame:
    """Per key: presence, key-path differences and size difference of two JSON copies."""
    from trialspark.functions.scalars import size_diff_pct

    side = lambda df, p: df.select(
        key,
        F.octet_length(json_col).alias(f"{p}_bytes"),
        F.array_sort(F.json_object_keys(json_col)).alias(f"{p}_top"),
        _paths_of(F.col(json_col)).alias(f"{p}_paths"),
    )
    ours, theirs = cut_lineage(side(local, "local")), cut_lineage(side(fetched, "fetched"))
    keyed = lambda df: df.filter(F.col(key).isNotNull())
    keyless = lambda df: df.filter(F.col(key).isNull())
    # a left and an anti join can be split where a key has many rows, a full join cannot; rows without a key meet nothing
    joined = (
        keyed(ours).join(keyed(theirs), key, "left")
        .unionByName(keyed(theirs).join(keyed(ours).select(key), key, "left_anti"), allowMissingColumns=True)
        .unionByName(keyless(ours), allowMissingColumns=True)
        .unionByName(keyless(theirs), allowMissingColumns=True)
    )
    in_local, in_fetched = missing_paths("local_paths", "fetched_paths")
    return joined.select(
        key,
        F.when(F.col("local_bytes").isNull(), "missing in local")
        .when(F.col("fetched_bytes").isNull(), "missing in fetched")
        .otherwise("compared")
        .alias("status"),
        F.array_size(in_local).alias("missing_in_local"),
        F.array_size(in_fetched).alias("missing_in_fetched"),
        size_diff_pct("local_bytes", "fetched_bytes").alias("size_difference_pct"),
        "local_top",
        "fetched_top",
    )


def structure_summary(compared: DataFrame) -> DataFrame:
    """Means over compared records, and whether every record has the same top-level keys."""
    both = compared.filter(F.col("status") == "compared")
    same = lambda c: (F.min(c) == F.max(c))
    return both.agg(
        F.count("*").alias("compared"),
        F.avg("size_difference_pct").alias("avg_size_difference_pct"),
        F.avg("missing_in_local").alias("avg_missing_in_local"),
        F.avg("missing_in_fetched").alias("avg_missing_in_fetched"),
        same(F.array_join("local_top", ",")).alias("local_consistent"),
        same(F.array_join("fetched_top", ",")).alias("fetched_consistent"),
    )
