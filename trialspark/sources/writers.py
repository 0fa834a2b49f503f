"""Parquet sinks: plain tables, snapshot-partitioned tables, shards, run reports, artifacts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialspark.functions.scalars import shard_hash
from trialspark.session import cut_lineage


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its own file system, local or remote."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(location)


def write_table(df: DataFrame, path: str, compression: str = "zstd") -> str:
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return path


def write_partitioned(
    df: DataFrame, path: str, partition: str = "source_snapshot_id", rebalance: bool = True, whole: bool = False
) -> str:
    """Replace only the partitions present in ``df``; running it again changes nothing.

    With ``whole`` the table becomes ``df``: partitions that ``df`` lacks are removed.

    Rows are rebalanced by the partition column: small partitions become one file each, and a
    partition with a large share of the rows is split over tasks. Rows of a single partition need
    no rebalancing.
    """
    (
        (df.hint("rebalance", F.col(partition)) if rebalance else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    return path


def with_shard(df: DataFrame, key: str, shards: int = 256) -> DataFrame:
    return df.withColumn("shard_id", (shard_hash(key) % shards).cast("int"))


def write_shards(df: DataFrame, key: str, path: str, shards: int = 256, rows_per_file: int = 5_000_000) -> DataFrame:
    """One folder per non-empty shard; returns the rows per shard as written.

    Rows are rebalanced by shard: the md5 shard is even over distinct keys, and a shard that one
    repeated key fills is split over tasks.
    """
    (
        with_shard(df, key, shards)
        .hint("rebalance", F.col("shard_id"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("shard_id")
        .parquet(path)
    )
    written = df.sparkSession.read.parquet(path)
    return written.groupBy("shard_id").agg(F.count("*").alias("record_count"))


def run_report(sections: dict[str, DataFrame]) -> DataFrame:
    """One JSON document of all stage statistics; each section is a one-row frame."""
    rows = [
        df.select(F.lit(name).alias("section"), F.to_json(F.struct(*df.columns)).alias("statistics"))
        for name, df in sections.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def write_report(sections: dict[str, DataFrame], path: str) -> str:
    run_report(sections).write.mode("overwrite").json(path)
    return path


def artifact_path(sha256: Column, filename: Column) -> Column:
    """``ab/<sha256><extension>``, the extension in lower case, ``.bin`` without one."""
    extension = F.lower(F.regexp_extract(filename, r"[^.](\.[^.]+)$", 1))
    suffix = F.when(extension != "", extension).otherwise(".bin")
    return F.concat(F.substring(sha256, 1, 2), F.lit("/"), sha256, suffix)


def catalogue_artifacts(files: DataFrame) -> DataFrame:
    """One row per distinct content of landed files (``path``, ``length``, ``content``).

    The content stays in the scan stage; only hash, length and name move. The smallest path names
    the artifact, so the catalogue does not depend on read order.
    """
    hashed = files.select(F.sha2("content", 256).alias("sha256"), "length", "path")
    named = hashed.groupBy("sha256").agg(
        F.min("path").alias("path"), F.max("length").alias("file_size"), F.count("*").alias("copies")
    )
    name = F.substring_index("path", "/", -1)
    return named.select(
        "sha256", artifact_path(F.col("sha256"), name).alias("raw_artifact_path"), "file_size", "copies"
    )


def store_artifacts(files: DataFrame, path: str) -> DataFrame:
    """Keep the content of landed files once per hash; returns the catalogue of ``files``.

    The store is a table of ``sha256``, ``raw_artifact_path``, ``file_size`` and ``content``, in folders by the
    first two digits of the hash. Only hashes move to find what is new; a content that is stored already,
    by this run or an earlier one, is not written again.
    """
    spark = files.sparkSession
    catalogue = cut_lineage(catalogue_artifacts(files))
    fresh = catalogue
    if path_exists(spark, path):
        fresh = catalogue.join(spark.read.parquet(path).select("sha256"), "sha256", "left_anti")
    named = files.select(F.sha2("content", 256).alias("sha256"), F.col("path").alias("_path"), "content")
    first = fresh.join(named.groupBy("sha256").agg(F.min("_path").alias("_path")), "sha256")
    rows = named.join(first, ["sha256", "_path"]).dropDuplicates(["sha256"])
    rows = rows.select("sha256", "raw_artifact_path", "file_size", "content", F.substring("sha256", 1, 2).alias("prefix"))
    rows.hint("rebalance", F.col("prefix")).write.mode("append").partitionBy("prefix").parquet(path)
    return catalogue


def read_stored(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Stored contents of the hashes in ``wanted`` (``sha256``); only their folders are read."""
    asked = wanted.select("sha256", F.substring("sha256", 1, 2).alias("prefix")).distinct()
    schema = "sha256 string, raw_artifact_path string, file_size long, content binary, prefix string"
    return spark.read.schema(schema).parquet(path).join(asked, ["prefix", "sha256"]).drop("prefix")


def read_artifacts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
