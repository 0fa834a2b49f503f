"""Dataset versions, fingerprints, promotion gates, snapshot deltas and lineage closure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from trialspark.session import cut_lineage, run_dir

LAYERS = ("bronze", "silver", "gold")


def version_id(layer, key, snapshot, fingerprint, transform) -> Column:
    """md5 of the five parts joined by colons; null when any part is null."""
    parts = [F.col(p) if isinstance(p, str) else p for p in (layer, key, snapshot, fingerprint, transform)]
    colon = F.lit(":")
    spaced = [p for part in parts for p in (colon, part.cast("string"))][1:]
    return F.md5(F.concat(*spaced))


def fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row (row count, digest) that ignores row order and partitioning.

    A row is the text of its columns, each with its length, null apart from empty. Halves of the rows' md5
    are summed and xor-ed; both merge map-side, and the sum keeps duplicates apart.
    """
    text = lambda c: F.col(c).cast("string")
    part = lambda c: F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("~"))
    hashed = df.select(F.md5(F.concat_ws(",", *[part(c) for c in (cols or df.columns)]).cast("binary")).alias("h"))
    bits = lambda at: F.conv(F.substring("h", at, 15), 16, 10).cast("bigint")
    sums = hashed.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.bit_xor(bits(1)), F.lit(0)).alias("x"),
        F.coalesce(F.sum(bits(16).cast("decimal(38,0)")), F.lit(0)).alias("s"),
    )
    return sums.select("row_count", F.md5(F.concat_ws(":", "row_count", "x", "s")).alias("fingerprint"))


def register(existing: DataFrame, new: DataFrame, natural_key: list[str]) -> DataFrame:
    """Rows of ``new`` to append: one per natural key, and only keys not registered yet.

    Of several rows with one key the smallest is registered, by the other columns in their order; maps,
    which have no order, take no part in the choice.
    """
    plain = [f.name for f in new.schema if f.name not in natural_key and not isinstance(f.dataType, MapType)]
    order = Window.partitionBy(*natural_key).orderBy(*(plain or natural_key))
    first = new.withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    return first.select(*new.columns).join(existing.select(*natural_key), natural_key, "left_anti")


def promote(
    requests: DataFrame, checks: DataFrame, require_all: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Promotion requests → (accepted, blocked with ``reason``).

    A version passes when any of its suites passed; with ``require_all``, when none failed either.
    Checks are reduced to one row per version before the join.
    """
    verdict = checks.groupBy("dataset_version_id").agg(
        F.bool_or(F.col("gate_status") == "passed").alias("any_passed"),
        F.bool_or(F.col("gate_status") == "failed").alias("any_failed"),
    )
    gate = F.coalesce("any_passed", F.lit(False))
    if require_all:
        gate = gate & ~F.col("any_failed")
    judged = requests.join(verdict, "dataset_version_id", "left").withColumn("_gate", gate)
    reason = F.when(F.col("any_passed").isNull(), "no quality check").otherwise("quality gate failed")
    accepted = judged.filter("_gate").drop("any_passed", "any_failed", "_gate")
    blocked = judged.filter("not _gate").withColumn("reason", reason).drop("any_passed", "any_failed", "_gate")
    return accepted, blocked


def passing_versions(versions: DataFrame, checks: DataFrame) -> DataFrame:
    return versions.join(
        checks.filter(F.col("gate_status") == "passed").select("dataset_version_id"),
        "dataset_version_id",
        "left_semi",
    )


def lacking_versions(versions: DataFrame, checks: DataFrame) -> DataFrame:
    return versions.join(
        checks.filter(F.col("gate_status") == "passed").select("dataset_version_id"),
        "dataset_version_id",
        "left_anti",
    )


def require_promotable(blocked: DataFrame) -> None:
    """Stop the job when a promotion is blocked, naming a few of the versions."""
    named = [r[0] for r in blocked.select("dataset_version_id").limit(5).collect()]
    if named:
        raise ValueError(f"quality gate failed or missing for dataset versions {named}")


def snapshot_delta(old: DataFrame, new: DataFrame, key: str, cols: list[str] | None = None) -> DataFrame:
    """inserted / updated / deleted / unchanged per key, with the names of changed columns.

    Both sides go into one grouping by key that counts the rows of each side and adds up their hashes (two
    of 64 bits), so a key that many rows repeat is summed in each task and no side is paired with the
    other. A key is unchanged when both sides hold the same rows, in any order. Only keys that differ are
    looked at again, to name the columns that do: null-safe, for a repeated key by the row with the smallest
    hash on each side. Rows without a key match nothing: each is deleted or inserted by itself, where it is.
    """
    cols = cols or [c for c in new.columns if c != key]
    names = F.array(*[F.lit(c) for c in cols])
    hashed = lambda df, side: df.filter(F.col(key).isNotNull()).select(
        F.col(key), F.lit(side).alias("_side"), F.xxhash64(*cols).alias("_h1"), F.xxhash64(F.lit(1), *cols).alias("_h2")
    )
    signed = lambda c: F.when(F.col("_side") == 1, F.col(c)).otherwise(-F.col(c))
    total = lambda c: F.sum(signed(c).cast("decimal(38,0)"))
    rows = hashed(old, 0).withColumns({c: F.col(c).cast("decimal(20,0)") for c in ("_h1", "_h2")})
    rows = rows.unionByName(hashed(new, 1).withColumns({c: F.col(c).cast("decimal(20,0)") for c in ("_h1", "_h2")}))
    judged = rows.groupBy(key).agg(
        F.count_if(F.col("_side") == 0).alias("_before"), F.count_if(F.col("_side") == 1).alias("_after"),
        total("_h1").alias("_d1"), total("_h2").alias("_d2"),
    )
    same = (F.col("_before") == F.col("_after")) & (F.col("_d1") == 0) & (F.col("_d2") == 0)
    change = (
        F.when(F.col("_before") == 0, "inserted").when(F.col("_after") == 0, "deleted").when(same, "unchanged").otherwise("updated")
    )
    judged = judged.select(key, change.alias("change"))
    differing = judged.filter("change = 'updated'").select(key)

    def representative(df: DataFrame, name: str) -> DataFrame:
        mine = df.join(differing, key, "left_semi").select(key, F.struct(*cols).alias(name), F.xxhash64(*cols).alias("_h"))
        order = Window.partitionBy(key).orderBy("_h")
        return mine.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select(key, name)

    pairs = representative(old, "_old").join(representative(new, "_new"), key)
    unlike = F.filter(
        names,
        lambda c: F.try_element_at(
            F.create_map(*[x for n in cols for x in (F.lit(n), ~F.col(f"_old.{n}").eqNullSafe(F.col(f"_new.{n}")))]), c
        ),
    )
    updated = pairs.select(key, F.lit("updated").alias("change"), unlike.alias("changed_columns"))
    none = F.array().cast("array<string>")
    settled = judged.filter("change <> 'updated'").select(key, "change", none.alias("changed_columns"))
    keyless = lambda df, change: df.filter(F.col(key).isNull()).select(key, F.lit(change).alias("change"), none.alias("changed_columns"))
    return settled.unionByName(updated).unionByName(keyless(old, "deleted")).unionByName(keyless(new, "inserted"))


def lineage_closure(edges: DataFrame, starts: DataFrame, direction: str = "down") -> DataFrame:
    """(node, depth): everything reachable from the start nodes, at its smallest depth.

    ``edges`` has ``parent`` and ``child``; ``starts`` has ``node``. One level per step until a
    level adds nothing; nodes already reached are dropped, so cycles end. The edges are written
    once and each level becomes a partition of one table, so a step plans two scans at any depth.
    """
    src, dst = ("parent", "child") if direction == "down" else ("child", "parent")
    spark = edges.sparkSession
    edges = cut_lineage(edges.select("parent", "child").filter(F.col("parent") != F.col("child")))
    base = run_dir(spark, "closure")
    node_type = dict(starts.dtypes)["node"]
    level = starts.select("node").distinct()
    depth = 0
    while True:
        level.write.parquet(f"{base}/depth={depth}")
        frontier = spark.read.schema(f"node {node_type}").parquet(f"{base}/depth={depth}")
        reached = spark.read.schema(f"node {node_type}, depth int").parquet(base)
        if frontier.isEmpty():
            return reached
        level = (
            edges.join(frontier.select(F.col("node").alias(src)), src)
            .select(F.col(dst).alias("node"))
            .distinct()
            .join(reached, "node", "left_anti")
        )
        depth += 1
