"""Parquet tables whose parts are replaced by pointing at new folders.

A table is divided into named parts (hash buckets, snapshots). Version N writes the parts it changes
below ``data/version=N`` and then, in ``versions/version=N``, says for every part of the table in which
version's folder it lies, with its rows and statistics. A version exists from the moment that write is
complete; nothing that an earlier version points at is touched, so a failed or repeated write never
harms what readers see. Folders that no kept version points at are removed by :func:`expire`.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: One row per part, and one without a part for the version itself.
_ROWS = "part string, in_version long, row_count long, stats map<string,string>, schema string, written_at timestamp"


def _location(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove_folder(spark: SparkSession, path: str) -> None:
    place, system = _location(spark, path)
    system.delete(place, True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions, oldest first."""
    place, system = _location(spark, f"{path}/versions")
    if not system.exists(place):
        return []
    names = [s.getPath().getName() for s in system.listStatus(place)]
    found = [n for n in names if n.startswith("version=")]
    done = [n for n in found if system.exists(spark._jvm.org.apache.hadoop.fs.Path(place, f"{n}/_SUCCESS"))]
    return sorted(int(n.partition("=")[2]) for n in done)


def log(spark: SparkSession, path: str) -> DataFrame:
    """``version`` and the row of each part, and of the version itself, for all versions."""
    rows = [(n, f"{path}/versions/version={n}") for n in versions(spark, path)]
    if not rows:
        return spark.createDataFrame([], f"version long, {_ROWS}")
    read = spark.read.schema(f"{_ROWS}, version long").option("basePath", f"{path}/versions").parquet(*[p for _, p in rows])
    return read.select("version", *[c for c in read.columns if c != "version"])


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Where the parts of a version (the newest by default) lie; no rows before the first."""
    known = versions(spark, path)
    if not known:
        return spark.createDataFrame([], _ROWS).drop("schema", "written_at")
    number = known[-1] if version is None else version
    rows = spark.read.schema(_ROWS).parquet(f"{path}/versions/version={number}")
    return rows.filter(F.col("part").isNotNull()).drop("schema", "written_at")


def read_version(
    spark: SparkSession, path: str, version: int | None = None, parts: list[str] | None = None
) -> DataFrame | None:
    """The rows of a version, or of some of its parts; null before the first version.

    Only the folders of those parts are listed. The driver sees one row per part.
    """
    known = versions(spark, path)
    if version is None and not known:
        return None
    number = known[-1] if version is None else version
    if number not in known:
        raise ValueError(f"{path} has no version {number}")
    rows = spark.read.schema(_ROWS).parquet(f"{path}/versions/version={number}").select("part", "in_version", "schema").collect()
    schema = StructType.fromJson(json.loads(next(r["schema"] for r in rows if r["part"] is None)))
    wanted = None if parts is None else set(parts)
    folders = [
        f"{path}/data/version={r['in_version']}/_part={r['part']}" for r in rows
        if r["part"] is not None and (wanted is None or r["part"] in wanted)
    ]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def write_version(
    df: DataFrame,
    path: str,
    part: Column,
    version: int | None = None,
    replaced: list[str] | None = None,
    whole: bool = False,
    stats: dict[str, Column] | None = None,
) -> int:
    """Write ``df`` as the new content of the parts it has rows in, and record the version.

    ``part`` names a row's part: text that can be a folder's name. Parts in ``replaced`` without rows in
    ``df`` become empty; with ``whole`` every part does that ``df`` lacks. ``stats`` are aggregates kept
    for each part, as text. A complete version is not written again. Parts are rebalanced: a large one is
    several files, small ones are one each. Returns the version.
    """
    spark = df.sparkSession
    known = versions(spark, path)
    number = (known[-1] + 1 if known else 0) if version is None else version
    if number in known:
        return number
    folder = f"{path}/data/version={number}"
    # the part is a folder name only: the files hold the columns of df
    df.withColumn("_part", part).hint("rebalance", F.col("_part")).write.mode("overwrite").partitionBy("_part").parquet(folder)
    written = spark.read.schema(StructType.fromJson(df.schema.jsonValue()).add("_part", "string")).parquet(folder)
    pairs = [x for n, c in (stats or {}).items() for x in (F.lit(n), c.cast("string"))]
    counted = written.groupBy("_part").agg(
        F.count("*").alias("n"), (F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")).alias("stats")
    )
    rows = [(r["_part"], number, r["n"], r["stats"], None, None) for r in counted.collect()]
    gone = {r[0] for r in rows} | set(replaced or ())
    if known and not whole:
        rows += [(*r, None, None) for r in manifest(spark, path, known[-1]).collect() if r["part"] not in gone]
    rows.append((None, number, None, None, df.schema.json(), datetime.now(timezone.utc)))
    spark.createDataFrame(rows, _ROWS).coalesce(1).write.mode("overwrite").parquet(f"{path}/versions/version={number}")
    return number


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove the part folders that none of the last ``keep`` versions points at; returns them.

    Records of versions stay, their statistics with them.
    """
    known = versions(spark, path)
    if len(known) <= keep:
        return []
    used = {
        f"version={r['in_version']}/_part={r['part']}"
        for r in log(spark, path).filter((F.col("version") >= known[-keep]) & F.col("part").isNotNull()).select("in_version", "part").collect()
    }
    gone = []
    place, system = _location(spark, f"{path}/data")
    for own in system.listStatus(place):
        name = own.getPath().getName()
        if int(name.partition("=")[2]) > known[-1]:
            continue  # not complete yet
        for inner in system.listStatus(own.getPath()):
            relative = f"{name}/{inner.getPath().getName()}"
            if inner.isDirectory() and relative not in used:
                system.delete(inner.getPath(), True)
                gone.append(f"{path}/data/{relative}")
    return gone
