"""A table's history as a base and one delta per run; any run can be read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialspark.operators.lineage import snapshot_delta
from trialspark.sources.versioned import remove_folder
from trialspark.sources.writers import path_exists


def runs(spark: SparkSession, path: str) -> DataFrame | None:
    """``run``, ``kind`` (base or delta), ``inserted``, ``updated``, ``deleted`` of each recorded run."""
    return spark.read.parquet(f"{path}/runs") if path_exists(spark, f"{path}/runs") else None


def write_run(df: DataFrame, path: str, run: int, key: str, base_every: int = 10) -> str:
    """Record a run: its changes against the run before, or the whole table every ``base_every`` runs.

    A delta holds the new row of each inserted or updated key and the key of each deleted one. A run
    counts once its row stands in ``runs``; a recorded run is not written again, and a failed one is
    written over. Keys are unique and not null. Returns the kind written.
    """
    spark = df.sparkSession
    known = runs(spark, path)
    if known is not None and not known.filter(F.col("run") == run).isEmpty():
        return known.filter(F.col("run") == run).first()["kind"]
    last_base = None if known is None else known.filter("kind = 'base'").agg(F.max("run")).first()[0]
    newest = None if known is None else known.agg(F.max("run")).first()[0]
    if newest is not None and run < newest:
        raise ValueError(f"run {run} is older than the recorded run {newest}")
    deltas = 0 if last_base is None else known.filter((F.col("kind") == "delta") & (F.col("run") > last_base)).count()
    counts = {"inserted": F.lit(None).cast("long"), "updated": F.lit(None).cast("long"), "deleted": F.lit(None).cast("long")}
    if last_base is None or deltas + 1 >= base_every:
        kind, folder = "base", f"{path}/base/run={run}"
        df.write.mode("overwrite").parquet(folder)
        counted = spark.read.parquet(folder).agg(F.count("*").alias("inserted"), F.lit(0).cast("long").alias("updated"), F.lit(0).cast("long").alias("deleted"))
    else:
        kind, folder = "delta", f"{path}/delta/run={run}"
        changes = snapshot_delta(read_run(spark, path, newest), df, key).filter("change <> 'unchanged'").select(key, "change")
        changes.join(df, key, "left").withColumnRenamed("change", "_change").write.mode("overwrite").parquet(folder)
        is_kind = lambda c: F.count_if(F.col("_change") == c)
        counted = spark.read.parquet(folder).agg(*[is_kind(c).alias(c) for c in counts])
    counted.select(F.lit(run).cast("long").alias("run"), F.lit(kind).alias("kind"), *counts).coalesce(1).write.mode("append").parquet(
        f"{path}/runs"
    )
    return kind


def read_run(spark: SparkSession, path: str, run: int | None = None) -> DataFrame:
    """The table as it was after a run (the newest by default): its base and the deltas up to it.

    Of a key's deltas the last decides; rows of the base without a delta stay as they are.
    """
    known = runs(spark, path)
    listed = [] if known is None else known.select("run", "kind").collect()
    number = max((r["run"] for r in listed), default=None) if run is None else run
    if number not in {r["run"] for r in listed}:
        raise ValueError(f"{path} has no run {run}")
    start = max(r["run"] for r in listed if r["kind"] == "base" and r["run"] <= number)
    base = spark.read.parquet(f"{path}/base/run={start}")
    steps = sorted(r["run"] for r in listed if r["kind"] == "delta" and start < r["run"] <= number)
    if not steps:
        return base
    deltas = spark.read.option("basePath", f"{path}/delta").parquet(*[f"{path}/delta/run={n}" for n in steps])
    key = _key_of(base, deltas)
    last = deltas.groupBy(key).agg(F.max("run").alias("run"))
    decided = deltas.join(last, [key, "run"])
    kept = base.join(decided.select(key), key, "left_anti")
    return kept.unionByName(decided.filter("_change <> 'deleted'").select(*base.columns))


def _key_of(base: DataFrame, deltas: DataFrame) -> str:
    """Deltas are written with the key first."""
    return next(c for c in deltas.columns if c in base.columns)


def compact(spark: SparkSession, path: str, keep_from: int) -> list[str]:
    """Remove bases and deltas that no run from ``keep_from`` on needs; returns the removed folders."""
    listed = runs(spark, path).select("run", "kind").collect()
    start = max((r["run"] for r in listed if r["kind"] == "base" and r["run"] <= keep_from), default=None)
    gone = []
    for r in listed:
        if start is not None and r["run"] < start:
            folder = f"{path}/{r['kind']}/run={r['run']}"
            if path_exists(spark, folder):
                remove_folder(spark, folder)
                gone.append(folder)
    return gone
