"""Snapshot-partitioned fact marts over the canonical Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialspark.sources.writers import path_exists, write_partitioned

# Fact mart → canonical table
FACT_SOURCES = {
    "trial_fact": "trial",
    "arm_fact": "arm",
    "endpoint_fact": "endpoint",
    "site_fact": "site",
    "publication_fact": "publication",
}


def require_sources(spark: SparkSession, canonical_dir: str, tables: list[str]) -> None:
    """Stop before anything is written when a table that a mart reads isn't there."""
    for table in tables:
        path = f"{canonical_dir}/{table}.parquet"
        if not path_exists(spark, path):
            raise FileNotFoundError(f"no canonical table {table!r} at {path}")


def mart_rows(source: DataFrame, snapshot_id: str, exported_at: datetime) -> DataFrame:
    """A snapshot id that the source already has is kept as ``origin_snapshot_id``."""
    return source.withColumnsRenamed({"source_snapshot_id": "origin_snapshot_id"}).withColumns(
        {"exported_at": F.lit(exported_at).cast("timestamp"), "source_snapshot_id": F.lit(snapshot_id)}
    )


def mart_counts(spark: SparkSession, output_dir: str, mapping: Mapping[str, str] = FACT_SOURCES) -> DataFrame:
    counts = [
        spark.read.parquet(f"{output_dir}/{fact}")
        .groupBy(F.col("source_snapshot_id").cast("string").alias("source_snapshot_id"))
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(fact).alias("fact_table"), "source_snapshot_id", "row_count")
        for fact in mapping
    ]
    return reduce(DataFrame.unionByName, counts)


def lineage_map(
    spark: SparkSession, canonical_dir: str, output_dir: str, mapping: Mapping[str, str] = FACT_SOURCES
) -> DataFrame:
    rows = [
        (fact, table, f"{canonical_dir}/{table}.parquet", f"{output_dir}/{fact}", "source_snapshot_id")
        for fact, table in mapping.items()
    ]
    return spark.createDataFrame(
        rows,
        "fact_table string, source_table string, source_parquet string, fact_parquet_dir string, "
        "partition_key string",
    )


def export_marts(
    spark: SparkSession,
    canonical_dir: str,
    output_dir: str,
    snapshot_id: str,
    mapping: Mapping[str, str] | None = None,
    exported_at: datetime | None = None,
) -> DataFrame:
    """Write every fact of the mapping for one snapshot; returns rows per fact of that snapshot.

    Other snapshots of the marts stay as they are. The lineage map is written next to the marts.
    """
    mapping = dict(mapping or FACT_SOURCES)
    exported_at = exported_at or datetime.now(timezone.utc)
    require_sources(spark, canonical_dir, list(mapping.values()))

    def write(fact: str, table: str) -> None:
        source = spark.read.parquet(f"{canonical_dir}/{table}.parquet")
        write_partitioned(mart_rows(source, snapshot_id, exported_at), f"{output_dir}/{fact}", rebalance=False)

    # submitted together: the tail of one mart leaves cores that the next can use
    with ThreadPoolExecutor(max_workers=min(8, max(1, len(mapping)))) as pool:
        list(pool.map(write, mapping.keys(), mapping.values()))
    lineage_map(spark, canonical_dir, output_dir, mapping).write.mode("overwrite").json(
        f"{output_dir}/mart_lineage_map"
    )
    return mart_counts(spark, output_dir, mapping).filter(F.col("source_snapshot_id") == snapshot_id)
