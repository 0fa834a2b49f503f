"""Landing of new study files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def study_file_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """New ``NCT*.json`` files as (nct_id, study_json)."""
    files = (
        spark.readStream.format("text")
        .schema("value string")
        .option("wholetext", True)
        .option("pathGlobFilter", "NCT*.json")
        .option("maxFilesPerTrigger", max_files)
        .load(path)
    )
    return files.select(
        F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("nct_id"),
        F.col("value").alias("study_json"),
    )


def parquet_stream(spark: SparkSession, path: str, schema, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def land(stream: DataFrame, target: str, checkpoint: str):
    """Append everything available to Parquet exactly once; returns the finished query.

    The files of a batch are looked up by a few tasks a core, not by a task each. A source reads this
    setting from its session at every batch, so the session's own value comes back after the last.
    """
    conf, key = stream.sparkSession.conf, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = conf.get(key)
    conf.set(key, 4 * stream.sparkSession.sparkContext.defaultParallelism)
    try:
        query = (
            stream.writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        conf.set(key, before)
    return query
