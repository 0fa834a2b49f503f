"""Incremental upserts, soft deletes, replay and request de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from trialspark.session import run_dir
from trialspark.sources import versioned


def _order(df: DataFrame, key: str, ts: str, tie: str | None) -> Column:
    """What decides between two rows of a key: time, then ``tie`` or all other columns that can be compared."""
    rest = [tie] if tie else [f.name for f in df.schema if f.name not in (key, ts, "is_active") and not isinstance(f.dataType, MapType)]
    return F.struct(ts, *rest)


def latest_per_key(df: DataFrame, key: str, ts: str, tie: str | None = None) -> DataFrame:
    """The newest row per key; ``tie`` decides equal times.

    Each task ranks its own rows first and sends one row per key to the shuffle, so a key with a large
    share of the rows is one row per task there.
    """
    newest = Window.partitionBy(key).orderBy(_order(df, key, ts, tie).desc())
    return df.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def _incoming(changes: DataFrame, deleted: str | None) -> DataFrame:
    active = F.lit(True) if deleted is None else ~F.coalesce(F.col(deleted), F.lit(False))
    flagged = changes.withColumn("is_active", active)
    return flagged if deleted is None else flagged.drop(deleted)


def upsert_batch(
    current: DataFrame, changes: DataFrame, key: str, ts: str, deleted: str | None = None, tie: str | None = None
) -> DataFrame:
    """Current rows with the changes applied; ``current`` has one row per key.

    The newest row per key wins, and an older or equal change never replaces a stored row. Rows whose
    ``deleted`` flag is set stay, with ``is_active`` false. Stored rows are neither sorted nor grouped:
    they meet the keys and times of the changes, and the changes theirs.
    """
    if deleted is None:
        flagged = changes
    else:  # the flag takes no part in the order
        flagged = changes.withColumnRenamed(deleted, "_deleted")
    plain = flagged if deleted is None else flagged.drop("_deleted")
    order = _order(plain, key, ts, tie)
    newest = Window.partitionBy(key).orderBy(order.desc())
    latest = flagged.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")
    latest = _incoming(latest, None if deleted is None else "_deleted").select(*current.columns)
    pairs = lambda df, name: df.select(F.col(key).alias("_key"), order.alias(name))
    meets = lambda a, b: a.join(b, a[key].eqNullSafe(b["_key"]), "left")
    kept = meets(current, pairs(latest, "_new")).filter(F.col("_new").isNull() | (order >= F.col("_new")))
    added = meets(latest, pairs(current, "_old")).filter(F.col("_old").isNull() | (order > F.col("_old")))
    return kept.select(*current.columns).unionByName(added.select(*current.columns))


def mark_missing(current: DataFrame, canonical: DataFrame, key: str) -> DataFrame:
    """Rows whose key left the canonical table become inactive; none is dropped."""
    present = canonical.select(key).distinct().withColumn("_present", F.lit(True))
    return (
        current.join(present, key, "left")
        .withColumn("is_active", F.col("is_active") & F.coalesce("_present", F.lit(False)))
        .drop("_present")
        .select(*current.columns)
    )


def changes_since(
    df: DataFrame, ts: str, snapshot: str, after: tuple[object, object] | None
) -> DataFrame:
    """Rows past a watermark (time, snapshot id): later ones, or those of a later snapshot."""
    if after is None:
        return df
    time, seen = after
    return df.filter((F.col(ts) > F.lit(time)) | (F.col(snapshot) > F.lit(seen)))


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")


def read_current(spark: SparkSession, target: str, version: int | None = None) -> DataFrame | None:
    """The newest complete version of a stream target, or a kept one; null before the first batch."""
    return versioned.read_version(spark, target, version)


def apply_batch(
    changes: DataFrame,
    batch_id: int,
    target: str,
    key: str,
    ts: str,
    deleted: str | None,
    tie: str | None,
    buckets: int = 64,
    snapshot: str | None = None,
    keep: int = 2,
) -> None:
    """Write version ``batch_id`` of the target: only buckets of changed keys are read and written.

    Keys are dealt into ``buckets`` by hash, a number that a target keeps for good; choose it so that a
    bucket is some hundred megabytes. A batch that was recorded before is skipped; one that failed before
    its record writes its own folders again. Versions older than the last ``keep`` are removed.
    """
    spark = changes.sparkSession
    if batch_id in versioned.versions(spark, target):
        return
    staged = run_dir(spark, "changes")
    changes.write.parquet(staged)
    own = spark.read.schema(changes.schema).parquet(staged)
    touched = sorted(r["b"] for r in own.select(bucket_of(key, buckets).alias("b")).distinct().collect())
    current = versioned.read_version(spark, target, parts=touched)
    if current is None:
        current = _incoming(own.limit(0), deleted)
    merged = upsert_batch(current, own, key, ts, deleted, tie)
    stats = {"active": F.count_if("is_active"), "watermark": F.max(F.unix_micros(F.col(ts).cast("timestamp")))}
    if snapshot is not None:
        stats["snapshot"] = F.max(snapshot)
    versioned.write_version(merged, target, bucket_of(key, buckets), batch_id, replaced=touched, stats=stats)
    versioned.expire(spark, target, keep)
    versioned.remove_folder(spark, staged)


def stream_upsert(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    key: str,
    ts: str,
    deleted: str | None = None,
    tie: str | None = None,
    buckets: int = 64,
    snapshot: str | None = None,
    keep: int = 2,
):
    """Run all available input through :func:`apply_batch` and return the finished query."""
    query = (
        stream.writeStream.foreachBatch(
            lambda changes, batch_id: apply_batch(changes, batch_id, target, key, ts, deleted, tie, buckets, snapshot, keep)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def sync_checkpoints(spark: SparkSession, target: str) -> DataFrame:
    """One row per batch: its rows, active rows and watermark, and the snapshot watermark where one is kept."""
    stat = lambda name: F.col("stats")[name]
    return versioned.log(spark, target).groupBy(F.col("version").alias("batch_id")).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(stat("active").cast("long")), F.lit(0)).alias("active_count"),
        F.timestamp_micros(F.max(stat("watermark").cast("long"))).alias("watermark"),
        F.max(stat("snapshot")).alias("snapshot_watermark"), F.max("written_at").alias("synced_at"),
    )


def replay(
    families: dict[str, DataFrame],
    target: str,
    snapshot: str | None = None,
    family: str | None = None,
    until: str | None = None,
    keep: int = 2,
) -> list[str]:
    """Rebuild one snapshot, a range of them and/or one entity family from the canonical tables.

    Each family is a table of snapshots (:mod:`trialspark.sources.versioned`): the new folders are
    written beside the old ones, and the table points at them once all are complete, so a rebuild that
    fails changes nothing, and one that reads its own target is safe. Snapshots that are asked for and
    no longer in the source become empty; without ``snapshot`` that is every snapshot of the family.
    ``until`` makes it a range, both ends included. Running it twice equals running it once. Returns the
    paths.
    """
    paths = []
    for name, df in families.items():
        if family is not None and name != family:
            continue
        spark, path = df.sparkSession, f"{target}/{name}"
        last = snapshot if until is None else until
        inside = lambda c: F.lit(True) if snapshot is None else c.between(snapshot, last)
        part = F.col("source_snapshot_id")
        known = versioned.manifest(spark, path).filter(inside(F.col("part"))).select("part").collect()
        versioned.write_version(
            df.filter(inside(part)), path, part, replaced=[r["part"] for r in known], whole=snapshot is None
        )
        versioned.expire(spark, path, keep)
        paths.append(path)
    return paths


def read_families(spark: SparkSession, target: str, names: list[str]) -> DataFrame:
    """Rows per family and snapshot of a replay target, counted from the files."""
    counts = [
        versioned.read_version(spark, f"{target}/{name}")
        .groupBy("source_snapshot_id")
        .agg(F.count("*").alias("n"))
        .select(F.lit(name).alias("family"), "source_snapshot_id", "n")
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


def dedupe_requests(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """First row per idempotency key within the watermark delay; state is bounded by the delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
