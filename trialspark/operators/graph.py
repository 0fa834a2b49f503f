"""The canonical tables as a property graph: projection, traversals and parity."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialspark.operators.validate import referential_breaks
from trialspark.session import cut_lineage

# label → (table, key without an id column of the table's own, name column)
NODES = {
    "Trial": ("trial", ["trial_id"], "nct_id"),
    "Sponsor": ("sponsor", ["sponsor_id"], "sponsor_name"),
    "Arm": ("arm", ["arm_id"], "arm_label"),
    "Intervention": ("intervention", ["intervention_id"], "intervention_name"),
    "Condition": ("condition", ["trial_id", "condition_name"], "condition_name"),
    "Biomarker": ("biomarker", ["trial_id", "biomarker_name"], "biomarker_name"),
    "Endpoint": ("endpoint", ["trial_id", "endpoint_type", "endpoint_name"], "endpoint_name"),
    "Publication": ("publication", ["publication_id"], "title"),
    "Site": ("site", ["site_id"], "facility_name"),
}
# relationship → label on the far side of the trial
TRIAL_EDGES = {
    "HAS_ARM": "Arm",
    "HAS_INTERVENTION": "Intervention",
    "STUDIES": "Condition",
    "MEASURES": "Endpoint",
    "HAS_BIOMARKER": "Biomarker",
    "HAS_PUBLICATION": "Publication",
    "HAS_SITE": "Site",
}


def _node_id(label: str, df: DataFrame | None = None) -> Column:
    """``Label:<table>_id``; a table that has no such column is keyed by the columns in :data:`NODES`."""
    table, ids, _ = NODES[label]
    if df is not None and f"{table}_id" in df.columns:
        ids = [f"{table}_id"]
    return F.concat_ws(":", F.lit(label), *[F.col(c).cast("string") for c in ids])


def _stamps(snapshot: str, projected_at: datetime | None) -> list[Column]:
    at = [] if projected_at is None else [F.lit(projected_at).cast("timestamp").alias("projected_at")]
    return [F.lit(True).alias("is_active"), F.lit(snapshot).alias("source_snapshot_id"), *at]


def node_parts(tables: dict[str, DataFrame], snapshot: str, projected_at: datetime | None = None) -> dict[str, DataFrame]:
    """The nodes of each label."""
    return {
        label: tables[table].select(
            F.lit(label).alias("label"),
            _node_id(label, tables[table]).alias("node_id"),
            F.col(name).cast("string").alias("name") if name in tables[table].columns else F.lit(None).cast("string").alias("name"),
            *_stamps(snapshot, projected_at),
        )
        for label, (table, _, name) in NODES.items()
    }


def graph_nodes(tables: dict[str, DataFrame], snapshot: str, projected_at: datetime | None = None) -> DataFrame:
    """(label, node_id, name, is_active, source_snapshot_id): nine projections, no shuffle.

    With ``projected_at`` every row carries that time too.
    """
    return reduce(DataFrame.unionByName, node_parts(tables, snapshot, projected_at).values())


def edge_parts(tables: dict[str, DataFrame], snapshot: str, projected_at: datetime | None = None) -> dict[str, DataFrame]:
    """The edges of each relationship."""
    stamp = _stamps(snapshot, projected_at)
    sponsor = F.concat_ws(":", F.lit("Sponsor"), F.col("sponsor_id").cast("string"))
    trial = F.concat_ws(":", F.lit("Trial"), F.col("trial_id").cast("string"))
    parts = {
        "SPONSORS": tables["trial"]
        .filter(F.col("sponsor_id").isNotNull())
        .select(sponsor.alias("src"), F.lit("SPONSORS").alias("relationship"), trial.alias("dst"), *stamp)
    }
    for relationship, label in TRIAL_EDGES.items():
        df = tables[NODES[label][0]]
        parts[relationship] = df.filter(F.col("trial_id").isNotNull()).select(
            trial.alias("src"), F.lit(relationship).alias("relationship"), _node_id(label, df).alias("dst"), *stamp
        )
    return parts


def graph_edges(tables: dict[str, DataFrame], snapshot: str, projected_at: datetime | None = None) -> DataFrame:
    """(src, relationship, dst, is_active, source_snapshot_id) from the foreign keys; ``projected_at`` as for nodes."""
    return reduce(DataFrame.unionByName, edge_parts(tables, snapshot, projected_at).values())


def project(tables: dict[str, DataFrame], snapshot: str, path: str, projected_at: datetime) -> tuple[DataFrame, DataFrame]:
    """Write nodes and edges below ``path``, by label and relationship; returns them as written.

    Fails closed: nothing is written from an extract with referential breaks. Each label and relationship is
    written on its own, so no task has to sort its rows by them first.
    """
    require_intact(tables)
    spark = tables["trial"].sparkSession
    nodes, edges = node_parts(tables, snapshot, projected_at), edge_parts(tables, snapshot, projected_at)
    for parts, name, part in ((nodes, "nodes", "label"), (edges, "edges", "relationship")):
        for kind, df in parts.items():
            df.drop(part).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}/{part}={kind}")
    return read_projection(spark, path)


def read_projection(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    common = "is_active boolean, source_snapshot_id string, projected_at timestamp"
    nodes = spark.read.schema(f"node_id string, name string, {common}, label string").parquet(f"{path}/nodes")
    edges = spark.read.schema(f"src string, dst string, {common}, relationship string").parquet(f"{path}/edges")
    return nodes, edges


def _facts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes and edges alike: ``kind``, ``key`` and two hashes of everything but the time of projection."""
    stamps = ["is_active", "source_snapshot_id"]
    parts = [
        nodes.select(F.col("label").alias("kind"), F.col("node_id").alias("key"), F.struct("name", *stamps).alias("v")),
        edges.select(F.col("relationship").alias("kind"), F.concat_ws(" > ", "src", "dst").alias("key"), F.struct(F.lit(None).cast("string").alias("name"), *stamps).alias("v")),
    ]
    both = parts[0].unionByName(parts[1])
    return both.select("kind", "key", F.xxhash64("key", "v").alias("h1"), F.xxhash64(F.lit(1), "key", "v").alias("h2"))


def parity_breaks(
    nodes: DataFrame, edges: DataFrame, tables: dict[str, DataFrame], snapshot: str, buckets: int = 256
) -> DataFrame:
    """Keys at which a written projection differs from what the canonical tables give: kind, key, problem.

    Both sides are reduced, map-side, to a count and order-free checksums for each kind and hash bucket of
    the key. Kinds and buckets whose sums differ are read again, and of their rows only a hash is moved: rows that
    both sides have equally often cancel out. What is left is compared key by key: ``missing`` from the
    projection, ``extra`` in it, or ``different`` in name, activity or snapshot. Equal projections cost two
    scans and no join of rows; a difference is lost only if two rows that differ share a 64-bit hash.
    """
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))

    def sums(facts: DataFrame, side: int) -> DataFrame:
        return facts.groupBy("kind", bucket).agg(F.count("*").alias("n"), wide("h1").alias("s1"), wide("h2").alias("s2")).withColumn("side", F.lit(side))

    written, expected = _facts(nodes, edges), _facts(graph_nodes(tables, snapshot), graph_edges(tables, snapshot))
    both = sums(written, 0).unionByName(sums(expected, 1))
    same = lambda c: F.min(c) == F.max(c)
    judged = both.groupBy("kind", "bucket").agg((same("n") & same("s1") & same("s2") & (F.count("*") == 2)).alias("same"))
    # at most kinds x buckets rows
    suspect = cut_lineage(judged.filter("not same").select("kind", "bucket"))
    kinds = [r["kind"] for r in suspect.select("kind").distinct().collect()]

    def narrowed(facts: DataFrame) -> DataFrame:
        # the literal kinds leave out whole parts of the projection and whole tables
        return facts.filter(F.col("kind").isin(kinds)).withColumn("bucket", bucket).join(suspect, ["kind", "bucket"], "left_semi")

    def sided() -> DataFrame:
        return narrowed(written).withColumn("side", F.lit(0)).unionByName(narrowed(expected).withColumn("side", F.lit(1)))

    surplus = F.sum(F.when(F.col("side") == 1, 1).otherwise(-1)).alias("surplus")
    row = F.xxhash64("kind", "h1", "h2").alias("row")
    unpaired = cut_lineage(sided().groupBy(row).agg(surplus).filter("surplus <> 0").select("row"))
    tagged = sided().withColumn("row", row).join(unpaired, "row", "left_semi")
    of = lambda side: F.count_if(F.col("side") == side)
    signed = lambda c: F.sum(F.when(F.col("side") == 1, F.col(c)).otherwise(-F.col(c)).cast("decimal(20,0)"))
    keyed = tagged.groupBy("kind", "key").agg(of(0).alias("have"), of(1).alias("want"), signed("h1").alias("d1"), signed("h2").alias("d2"))
    problem = F.when(F.col("have") < F.col("want"), "missing").when(F.col("have") > F.col("want"), "extra").when((F.col("d1") != 0) | (F.col("d2") != 0), "different")
    return keyed.select("kind", "key", problem.alias("problem")).filter("problem is not null")


def projection_parity(nodes: DataFrame, edges: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Projected against canonical counts per label and relationship."""
    projected = (
        nodes.groupBy(F.col("label").alias("kind"))
        .agg(F.count("*").alias("projected"))
        .unionByName(edges.groupBy(F.col("relationship").alias("kind")).agg(F.count("*").alias("projected")))
    )
    counted = [
        tables[table].agg(F.count("*").alias("canonical")).withColumn("kind", F.lit(label))
        for label, (table, _, _) in NODES.items()
    ]
    counted.append(
        tables["trial"].agg(F.count("sponsor_id").alias("canonical")).withColumn("kind", F.lit("SPONSORS"))
    )
    counted += [
        tables[NODES[label][0]].agg(F.count("trial_id").alias("canonical")).withColumn("kind", F.lit(relationship))
        for relationship, label in TRIAL_EDGES.items()
    ]
    canonical = reduce(DataFrame.unionByName, counted)
    return projected.join(canonical, "kind", "full").select(
        "kind",
        F.coalesce("projected", F.lit(0)).alias("projected"),
        F.coalesce("canonical", F.lit(0)).alias("canonical"),
        (F.coalesce("projected", F.lit(0)) - F.coalesce("canonical", F.lit(0))).alias("diff"),
    )


FOREIGN_KEYS = [("trial", "sponsor_id", "sponsor", "sponsor_id")] + [
    (NODES[label][0], "trial_id", "trial", "trial_id") for label in TRIAL_EDGES.values()
]


def require_intact(tables: dict[str, DataFrame]) -> None:
    """Fail closed: no projection from an extract with referential breaks."""
    broken = referential_breaks(tables, FOREIGN_KEYS).filter(F.col("orphans") > 0).collect()
    if broken:
        raise ValueError("referential breaks: " + ", ".join(f"{r.foreign_key} ({r.orphans})" for r in broken))


def landscape(tables: dict[str, DataFrame], intervention_like: str, condition_like: str, limit: int = 100) -> DataFrame:
    """Trials whose intervention and condition match, with their biomarkers if any.

    Both patterns filter before the join; biomarkers are gathered only for matching trials.
    """
    wanted = lambda c, text: F.contains(F.lower(c), F.lit(text.lower()))
    interventions = (
        tables["intervention"]
        .filter(wanted(F.col("intervention_name"), intervention_like))
        .select("trial_id", "intervention_name")
        .distinct()
    )
    conditions = (
        tables["condition"]
        .filter(wanted(F.col("condition_name"), condition_like))
        .select("trial_id", "condition_name")
        .distinct()
    )
    matched = interventions.join(conditions, "trial_id")
    markers = (
        tables["biomarker"]
        .join(matched.select("trial_id"), "trial_id", "left_semi")
        .groupBy("trial_id")
        .agg(F.array_sort(F.collect_set("biomarker_name")).alias("biomarkers"))
    )
    return (
        matched.join(tables["trial"].select("trial_id", "nct_id"), "trial_id")
        .join(markers, "trial_id", "left")
        .withColumn("biomarkers", F.coalesce("biomarkers", F.array().cast("array<string>")))
        .orderBy("nct_id", "intervention_name", "condition_name")
        .limit(limit)
    )


def sponsor_portfolio(tables: dict[str, DataFrame], limit: int = 50) -> DataFrame:
    """Trials per sponsor name and condition.

    (trial, condition) pairs are distinct and a trial has one sponsor, so a plain count is exact and
    merges map-side.
    """
    pairs = tables["condition"].select("trial_id", "condition_name").distinct()
    return (
        pairs.join(tables["trial"].select("trial_id", "sponsor_id"), "trial_id")
        .groupBy("sponsor_id", "condition_name")
        .agg(F.count("*").alias("n"))
        .join(tables["sponsor"].select("sponsor_id", "sponsor_name"), "sponsor_id")
        .groupBy("sponsor_name", "condition_name")
        .agg(F.sum("n").alias("trial_count"))
        .orderBy(F.desc("trial_count"), "sponsor_name", "condition_name")
        .limit(limit)
    )


def endpoint_strategy(tables: dict[str, DataFrame], limit: int = 100) -> DataFrame:
    """Trials per condition and endpoint; both sides are distinct per trial before they meet."""
    conditions = tables["condition"].select("trial_id", "condition_name").distinct()
    endpoints = tables["endpoint"].select("trial_id", "endpoint_type", "endpoint_name").distinct()
    keys = ["condition_name", "endpoint_type", "endpoint_name"]
    return (
        conditions.join(endpoints, "trial_id")
        .join(tables["trial"].select("trial_id"), "trial_id", "left_semi")
        .groupBy(*keys)
        .agg(F.count("*").alias("trials"))
        .orderBy(F.desc("trials"), *keys)
        .limit(limit)
    )


def evidence(trials: DataFrame, publications: DataFrame, nct_id: str, limit: int = 25) -> DataFrame:
    """Publications of one trial, newest first."""
    return (
        trials.filter(F.col("nct_id") == nct_id)
        .select("trial_id", "nct_id", "source_snapshot_id")
        .join(publications.select("trial_id", "publication_id", "title", "journal", "published_at"), "trial_id")
        .orderBy(F.desc_nulls_last("published_at"), "publication_id")
        .limit(limit)
    )


def k_hop(edges: DataFrame, start: str, k: int, directed: bool = False, stored: bool = False) -> DataFrame:
    """(node, hops, path) within k steps of a node, each by its smallest shortest path.

    A step keeps one path per node, chosen by a map-side minimum, so hubs do not multiply paths.
    Edges are written once and each level after it. ``stored`` edges are a projection of tables in files:
    they are not written again, and each level reads them there.
    """
    links = edges.select("src", "dst")
    if not stored:
        links = cut_lineage(links)
    if not directed:
        links = links.select(F.inline(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))))
    spark = edges.sparkSession
    frontier = spark.range(1).select(
        F.lit(start).alias("node"), F.lit(0).alias("hops"), F.array(F.lit(start)).alias("path")
    )
    reached = frontier
    for hop in range(1, k + 1):
        step = (
            frontier.select(F.col("node").alias("src"), "path")
            .join(links, "src")
            .groupBy(F.col("dst").alias("node"))
            .agg(F.min("path").alias("path"))
            .join(reached.select("node"), "node", "left_anti")
            .select("node", F.lit(hop).alias("hops"), F.concat("path", F.array("node")).alias("path"))
        )
        frontier = cut_lineage(step)
        reached = reached.unionByName(frontier)
    return reached
