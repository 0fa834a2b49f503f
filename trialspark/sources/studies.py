"""Readers for study files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialspark import schemas
from trialspark.operators.flatten import parse_studies
from trialspark.session import run_dir


def read_study_csv(spark: SparkSession, path: str) -> DataFrame:
    """The wide study table as text columns; quoted fields may span lines."""
    return (
        spark.read.schema(schemas.CSV_DDL)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def study_folders(spark: SparkSession, path: str) -> list[str]:
    """The ``folder-*`` folders that the files of a large collection are dealt to; ``path`` itself if it has none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/folder-*")
    found = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(place)
    return sorted(s.getPath().toString() for s in found or []) or [path]


def read_study_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON files, one study each: (nct_id = file stem, study_json).

    The files lie in ``path`` or in its ``folder-*`` folders. These are listed and read one after the other
    into the shared folder, so the driver holds the names of one folder's files at a time.
    """
    def files(folder: str) -> DataFrame:
        found = spark.read.option("pathGlobFilter", "NCT*.json").text(folder, wholetext=True)
        return found.select(
            F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("nct_id"),
            F.col("value").alias("study_json"),
        )

    folders = study_folders(spark, path)
    if folders == [path]:
        return files(path)
    kept = run_dir(spark, "read-studies")
    for folder in folders:
        # a scan counts a small file as megabytes: thousands of tasks of a few files without this
        files(folder).coalesce(4 * spark.sparkContext.defaultParallelism).write.mode("append").parquet(kept)
    return spark.read.schema("nct_id string, study_json string").parquet(kept)


def load_studies(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable studies, quarantined ones): unreadable records are kept aside, not lost."""
    parsed = parse_studies(raw)
    good = parsed.filter(F.col("corrupt_record").isNull()).drop("corrupt_record")
    return good, parsed.filter(F.col("corrupt_record").isNotNull()).select("nct_id", "corrupt_record")


def restrict_to(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")

