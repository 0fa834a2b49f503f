"""Graph projection and traversals."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from trialspark.operators import graph, validate
from trialspark.plans.registry import query
from trialspark.plans.tables import Tables
from trialspark.session import run_dir

_ALL = "trial sponsor arm intervention condition biomarker endpoint publication site"
_COUNTS = {
    "Trial": ("trial", "SPONSORS"), "Sponsor": ("sponsor", None), "Arm": ("arm", "HAS_ARM"),
    "Intervention": ("intervention", "HAS_INTERVENTION"), "Condition": ("condition", "STUDIES"),
    "Biomarker": ("biomarker", "HAS_BIOMARKER"), "Endpoint": ("endpoint", "MEASURES"),
    "Publication": ("publication", "HAS_PUBLICATION"), "Site": ("site", "HAS_SITE"),
}


@query(
    "gr01_nodes",
    " UNION ALL ".join(
        f"SELECT '{label}' AS label, count(*) AS nodes, count(*) AS distinct_ids, 'snapshot-1' AS source_snapshot_id FROM {table}"
        for label, (table, _) in _COUNTS.items()
    ),
    _ALL,
)
def nodes(t: Tables):
    return graph.graph_nodes(t.canonical(), "snapshot-1").groupBy("label", "source_snapshot_id").agg(
        F.count("*").alias("nodes"), F.count_distinct("node_id").alias("distinct_ids")
    )


@query(
    "gr01_sponsor_and_site_nodes",
    """SELECT concat('Sponsor:', sponsor_id) AS node_id, sponsor_name AS name, true AS is_active FROM sponsor
       UNION ALL SELECT concat('Site:', site_id), facility_name, true FROM site""",
    "sponsor site",
)
def some_nodes(t: Tables):
    found = graph.graph_nodes(t.canonical(), "snapshot-1").filter(F.col("label").isin("Sponsor", "Site"))
    return found.select("node_id", "name", "is_active")


@query(
    "gr02_edges",
    """SELECT concat('Sponsor:', sponsor_id) AS src, 'SPONSORS' AS relationship, concat('Trial:', trial_id) AS dst FROM trial WHERE sponsor_id IS NOT NULL
       UNION ALL SELECT concat('Trial:', trial_id), 'HAS_ARM', concat('Arm:', arm_id) FROM arm
       UNION ALL SELECT concat('Trial:', trial_id), 'HAS_INTERVENTION', concat('Intervention:', intervention_id) FROM intervention
       UNION ALL SELECT concat('Trial:', trial_id), 'STUDIES', concat('Condition:', trial_id, ':', condition_name) FROM condition
       UNION ALL SELECT concat('Trial:', trial_id), 'MEASURES', concat('Endpoint:', trial_id, ':', endpoint_type, ':', endpoint_name) FROM endpoint
       UNION ALL SELECT concat('Trial:', trial_id), 'HAS_BIOMARKER', concat('Biomarker:', trial_id, ':', biomarker_name) FROM biomarker
       UNION ALL SELECT concat('Trial:', trial_id), 'HAS_PUBLICATION', concat('Publication:', publication_id) FROM publication
       UNION ALL SELECT concat('Trial:', trial_id), 'HAS_SITE', concat('Site:', site_id) FROM site""",
    _ALL,
)
def edges(t: Tables):
    return graph.graph_edges(t.canonical(), "snapshot-1").select("src", "relationship", "dst")


@query(
    "ag21_gr06_projection_parity",
    " UNION ALL ".join(
        [f"SELECT '{label}' AS kind, count(*) AS projected, count(*) AS canonical, 0::BIGINT AS diff FROM {table}" for label, (table, _) in _COUNTS.items()]
        + [f"SELECT '{edge}', count({'sponsor_id' if edge == 'SPONSORS' else '*'}), count({'sponsor_id' if edge == 'SPONSORS' else '*'}), 0 FROM {table}" for table, edge in _COUNTS.values() if edge]
    ),
    _ALL,
)
def parity(t: Tables):
    """Counts of the projection as written against the canonical tables."""
    tables = t.stored()
    nodes, edges = graph.project(tables, "snapshot-1", run_dir(t.spark, "projection"), PROJECTED_AT)
    return graph.projection_parity(nodes, edges, tables)


PROJECTED_AT = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


@query(
    "gr06_parity_breaks",
    """SELECT 'Trial' AS kind, concat('Trial:', trial_id) AS key, 'missing' AS problem FROM trial WHERE trial_id % 501 = 1
       UNION ALL SELECT 'Site', concat('Site:', site_id), 'different' FROM site WHERE site_id % 997 = 3
       UNION ALL SELECT 'HAS_ARM', concat('Trial:', trial_id, ' > Arm:', arm_id), 'extra' FROM arm WHERE arm_id % 1009 = 1
       UNION ALL SELECT 'SPONSORS', concat('Sponsor:', sponsor_id, ' > Trial:', trial_id), 'different' FROM trial WHERE trial_id % 1499 = 2 AND sponsor_id IS NOT NULL""",
    "trial site arm",
)
def parity_breaks(t: Tables):
    """A projection with planted faults: lost nodes, other names, doubled edges, edges of another snapshot."""
    tables, path = t.stored(), run_dir(t.spark, "projection")
    nodes, edges = graph.project(tables, "snapshot-1", path, PROJECTED_AT)
    tail = lambda c: F.regexp_extract(c, r"(\d+)$", 1).cast("bigint")
    nodes = nodes.filter(~((F.col("label") == "Trial") & (tail("node_id") % 501 == 1)))
    nodes = nodes.withColumn("name", F.when((F.col("label") == "Site") & (tail("node_id") % 997 == 3), "renamed").otherwise(F.col("name")))
    doubled = edges.filter((F.col("relationship") == "HAS_ARM") & (tail("dst") % 1009 == 1))
    stale = (F.col("relationship") == "SPONSORS") & (tail("dst") % 1499 == 2)
    edges = edges.withColumn("source_snapshot_id", F.when(stale, "snapshot-0").otherwise(F.col("source_snapshot_id"))).unionByName(doubled)
    return graph.parity_breaks(nodes, edges, tables, "snapshot-1")


@query(
    "jn09_referential_breaks",
    """SELECT 'trial.sponsor_id -> sponsor.sponsor_id' AS foreign_key, count(*) AS orphans FROM trial
         WHERE sponsor_id IS NOT NULL AND sponsor_id NOT IN (SELECT sponsor_id FROM sponsor) """
    + " ".join(
        f"UNION ALL SELECT '{table}.trial_id -> trial.trial_id', count(*) FROM {table} WHERE trial_id NOT IN (SELECT trial_id FROM trial)"
        for table in "arm intervention condition endpoint biomarker publication site".split()
    ),
    _ALL,
)
def breaks(t: Tables):
    return validate.referential_breaks(t.canonical(), graph.FOREIGN_KEYS)


@query(
    "jn09_orphan_rows",
    "SELECT o_orderkey AS trial_id, o_custkey AS sponsor_id FROM orders WHERE o_custkey + 40 NOT IN (SELECT c_custkey FROM customer)",
)
def orphans(t: Tables):
    shifted = t.trial.withColumn("sponsor_id", F.col("sponsor_id") + 40)
    found = validate.orphans(shifted, t.sponsor, "sponsor_id", "sponsor_id")
    return found.select("trial_id", (F.col("sponsor_id") - 40).alias("sponsor_id"))


@query(
    "jn06_optional_biomarkers",
    """SELECT t.trial_id, coalesce(string_agg(biomarker_name, ', ' ORDER BY biomarker_name), '') AS biomarkers
       FROM trial t LEFT JOIN biomarker b ON b.trial_id = t.trial_id GROUP BY 1""",
    "trial biomarker",
)
def optional(t: Tables):
    markers = t.biomarker.groupBy("trial_id").agg(F.array_sort(F.collect_set("biomarker_name")).alias("b"))
    joined = t.trial.select("trial_id").join(markers, "trial_id", "left")
    return joined.select("trial_id", F.coalesce(F.array_join("b", ", "), F.lit("")).alias("biomarkers"))


@query(
    "gr03_landscape",
    """WITH m AS (SELECT DISTINCT t.trial_id, t.nct_id, i.intervention_name, c.condition_name FROM trial t JOIN intervention i USING (trial_id)
         JOIN condition c USING (trial_id) WHERE contains(lower(i.intervention_name), 'red') AND contains(lower(c.condition_name), 'econ')),
       b AS (SELECT trial_id, string_agg(biomarker_name, ', ' ORDER BY biomarker_name) AS biomarkers FROM biomarker GROUP BY 1)
       SELECT m.trial_id, nct_id, intervention_name, condition_name, coalesce(biomarkers, '') AS biomarkers FROM m LEFT JOIN b ON m.trial_id = b.trial_id
       ORDER BY nct_id, intervention_name, condition_name LIMIT 100""",
    "trial intervention condition biomarker",
)
def landscape(t: Tables):
    found = graph.landscape(t.canonical(), "red", "ECON")
    return found.withColumn("biomarkers", F.array_join("biomarkers", ", "))


@query(
    "gr04_ag19_sponsor_portfolio",
    """SELECT sponsor_name, condition_name, count(DISTINCT t.trial_id) AS trial_count FROM sponsor s JOIN trial t ON s.sponsor_id = t.sponsor_id
       JOIN condition c ON c.trial_id = t.trial_id GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 50""",
    "sponsor trial condition",
)
def portfolio(t: Tables):
    return graph.sponsor_portfolio(t.canonical())


@query(
    "gr04_ag20_endpoint_strategy",
    """SELECT condition_name, endpoint_type, endpoint_name, count(DISTINCT t.trial_id) AS trials FROM trial t JOIN endpoint e ON e.trial_id = t.trial_id
       JOIN condition c ON c.trial_id = t.trial_id GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3 LIMIT 100""",
    "trial endpoint condition",
)
def strategy(t: Tables):
    return graph.endpoint_strategy(t.canonical())


_DRILL = """WITH busiest AS (SELECT trial_id FROM publication JOIN trial USING (trial_id) GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT nct_id, publication_id, title, journal, strftime(published_at, '%Y-%m-%d') AS published_at, source_snapshot_id
FROM publication JOIN trial USING (trial_id) WHERE trial_id IN (SELECT trial_id FROM busiest)
"""


@query("gr04_sl06_evidence", _DRILL + "ORDER BY publication.published_at DESC, publication_id LIMIT 25", "publication trial")
def evidence(t: Tables):
    known = t.publication.join(t.trial.select("trial_id", "nct_id"), "trial_id")
    busiest = known.groupBy("trial_id", "nct_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "trial_id").first()
    found = graph.evidence(t.trial, t.publication, busiest["nct_id"])
    return found.drop("trial_id").withColumn("published_at", F.col("published_at").cast("string"))


@query(
    "gr05_k_hop",
    """WITH RECURSIVE e AS (SELECT concat('Sponsor:', sponsor_id) AS a, concat('Trial:', trial_id) AS b FROM trial
         UNION ALL SELECT concat('Trial:', trial_id), concat('Site:', site_id) FROM site
         UNION ALL SELECT concat('Trial:', trial_id), concat('Arm:', arm_id) FROM arm
         UNION ALL SELECT concat('Trial:', trial_id), concat('Intervention:', intervention_id) FROM intervention
         UNION ALL SELECT concat('Trial:', trial_id), concat('Condition:', trial_id, ':', condition_name) FROM condition
         UNION ALL SELECT concat('Trial:', trial_id), concat('Endpoint:', trial_id, ':', endpoint_type, ':', endpoint_name) FROM endpoint
         UNION ALL SELECT concat('Trial:', trial_id), concat('Biomarker:', trial_id, ':', biomarker_name) FROM biomarker
         UNION ALL SELECT concat('Trial:', trial_id), concat('Publication:', publication_id) FROM publication),
       both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
       walk AS (SELECT 'Sponsor:7' AS node, 0 AS hops, ['Sponsor:7'] AS path UNION ALL
         SELECT b, hops + 1, list_append(path, b) FROM walk JOIN both_ways ON a = node WHERE hops < 3 AND NOT list_contains(path, b)),
       best AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY hops, path) AS r FROM walk)
       SELECT node, hops::BIGINT AS hops, array_to_string(path, ' > ') AS path FROM best WHERE r = 1""",
    _ALL,
)
def k_hop(t: Tables):
    """Three steps from a sponsor over all eight relationships."""
    found = graph.k_hop(graph.graph_edges(t.canonical(), "s"), "Sponsor:7", 3)
    return found.select("node", F.col("hops").cast("bigint").alias("hops"), F.array_join("path", " > ").alias("path"))
