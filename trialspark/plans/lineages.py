"""Versions, validity, lineage, promotion and deltas."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialspark.operators import lineage, quality, scd
from trialspark.plans.registry import query
from trialspark.plans.tables import Tables

_VERSIONS = """WITH v AS (SELECT *, row_number() OVER w AS version_number, lead(updated_at) OVER w AS valid_to,
    lag(op) OVER w AS old_op, lag(enrollment) OVER w AS old_enrollment, row_number() OVER w = 1 AS is_first
  FROM updates WINDOW w AS (PARTITION BY trial_id ORDER BY updated_at, event_id))
"""


def _versions(t: Tables):
    return scd.build_scd2(t.updates, "trial_id", "updated_at", ["op", "enrollment"], "event_id")


def micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


@query(
    "ln08_wn02_wn03_scd2",
    _VERSIONS
    + """SELECT event_id, trial_id, version_number, epoch_us(updated_at) AS valid_from_us, epoch_us(valid_to) AS valid_to_us,
       valid_to IS NULL AS is_current FROM v""",
    "updates",
)
def versions(t: Tables):
    return _versions(t).select(
        "event_id", "trial_id", "version_number", micros("valid_from").alias("valid_from_us"),
        micros("valid_to").alias("valid_to_us"), "is_current",
    )


@query(
    "wn04_changed_fields",
    _VERSIONS
    + """SELECT event_id, version_number, CASE WHEN NOT is_first AND op IS DISTINCT FROM old_op THEN concat(old_op, '>', op) END AS op_change,
       NOT is_first AND enrollment IS DISTINCT FROM old_enrollment AS enrollment_changed FROM v""",
    "updates",
)
def changed(t: Tables):
    change = F.try_element_at("changed_fields", F.lit("op"))
    return _versions(t).select(
        "event_id", "version_number",
        F.when(change.isNotNull(), F.concat(change["old"], F.lit(">"), change["new"])).alias("op_change"),
        F.map_contains_key("changed_fields", "enrollment").alias("enrollment_changed"),
    )


@query(
    "jn08_as_of_lookup",
    _VERSIONS
    + """, asked AS (SELECT o_orderkey AS lookup_id, o_custkey % 150 AS trial_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey * 173 % 2592000) AS asked_at FROM orders)
       SELECT a.lookup_id, a.trial_id, v.event_id, v.version_number FROM asked a JOIN v ON a.trial_id = v.trial_id
       AND a.asked_at >= v.updated_at AND (v.valid_to IS NULL OR a.asked_at < v.valid_to)""",
    "updates",
)
def as_of(t: Tables):
    seconds = F.col("o_orderkey") * 173 % 2592000
    asked = t.orders.select(
        F.col("o_orderkey").alias("lookup_id"), (F.col("o_custkey") % 150).alias("trial_id"),
        F.timestamp_seconds(seconds + 1704067200).cast("timestamp_ntz").alias("asked_at"),
    )
    versions = _versions(t).select("trial_id", "event_id", "version_number", "valid_from", "valid_to")
    found = scd.as_of(versions, asked, "trial_id", "asked_at", "lookup_id")
    return found.select("lookup_id", "trial_id", "event_id", "version_number")


@query(
    "wn05_first_request",
    """SELECT idempotency_key, event_id, epoch_us(ts) AS requested_us FROM (SELECT concat(user_id, '-', event_type) AS idempotency_key, event_id, ts,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""",
)
def first_request(t: Tables):
    requests = t.events.select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("idempotency_key"), "event_id",
        F.col("ts").alias("requested_at"),
    )
    first = scd.first_request(requests, tie="event_id")
    return first.select("idempotency_key", "event_id", micros("requested_at").alias("requested_us"))


@query(
    "wn08_rolling_metrics",
    """WITH d AS (SELECT event_type, ts::DATE AS day, count(*) AS n, sum(value) AS s, max(value) AS p FROM events GROUP BY 1, 2)
       SELECT event_type, strftime(day, '%Y-%m-%d') AS day, (sum(n) OVER w)::BIGINT AS rolling_count, round(sum(s) OVER w / sum(n) OVER w, 6) AS rolling_avg,
         max(p) OVER w AS rolling_max FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
)
def rolling(t: Tables):
    found = scd.rolling_metrics(t.events, "ts", "value", "event_type", days=7)
    return found.withColumns({"day": F.col("day").cast("string"), "rolling_avg": F.round("rolling_avg", 6)})


@query(
    "ln01_version_ids",
    """SELECT o_orderkey, md5(concat('silver', ':', 'trial', ':', concat('snapshot-', year(o_orderdate)), ':', md5(o_orderkey::VARCHAR), ':', 'v1'))
         AS version_id FROM orders""",
)
def version_ids(t: Tables):
    snapshot = F.concat(F.lit("snapshot-"), F.year("o_orderdate").cast("string"))
    made = lineage.version_id(
        F.lit("silver"), F.lit("trial"), snapshot, F.md5(F.col("o_orderkey").cast("string")), F.lit("v1")
    )
    return t.orders.select("o_orderkey", made.alias("version_id"))


_LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(
    "ln02_fingerprint",
    f"""WITH h AS (SELECT md5(concat_ws(',', {", ".join(f"coalesce(concat(length({c}::VARCHAR), ':', {c}::VARCHAR), '~')" for c in _LINE_COLUMNS)})) AS h FROM lineitem),
        n AS (SELECT count(*) AS n, bit_xor(('0x' || substr(h, 1, 15))::BIGINT) AS x, sum(('0x' || substr(h, 16, 15))::BIGINT) AS s FROM h)
        SELECT n AS row_count, md5(concat_ws(':', n, x, s)) AS fingerprint FROM n""",
)
def fingerprint(t: Tables):
    return lineage.fingerprint(t.lineitem, _LINE_COLUMNS)


def _datasets(t: Tables):
    snapshot = F.concat(F.lit("snapshot-"), (F.col("o_orderkey") % 50).cast("string"))
    return t.orders.select(F.col("o_orderpriority").alias("dataset_key"), snapshot.alias("source_snapshot_id"), "o_orderkey")


@query(
    "ln03_register_idempotent",
    """WITH d AS (SELECT o_orderpriority AS dataset_key, concat('snapshot-', o_orderkey % 50) AS source_snapshot_id, o_orderkey FROM orders)
       SELECT DISTINCT dataset_key, source_snapshot_id FROM d WHERE (dataset_key, source_snapshot_id) NOT IN
         (SELECT (dataset_key, source_snapshot_id) FROM d WHERE o_orderkey % 50 < 20)""",
)
def registered(t: Tables):
    known = _datasets(t).filter(F.col("o_orderkey") % 50 < 20).select("dataset_key", "source_snapshot_id").distinct()
    added = lineage.register(known, _datasets(t), ["dataset_key", "source_snapshot_id"])
    return added.select("dataset_key", "source_snapshot_id")


_CHECKS = """WITH q AS (SELECT o_orderkey AS v, CASE WHEN l_quantity > 25 THEN 'passed' ELSE 'failed' END AS g FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
s AS (SELECT v, bool_or(g = 'passed') AS any_passed, bool_or(g = 'failed') AS any_failed FROM q GROUP BY 1)
"""


def _checks(t: Tables):
    return t.lineitem.select(
        F.col("l_orderkey").alias("dataset_version_id"), F.col("l_linenumber").cast("string").alias("check_suite"),
        F.when(F.col("l_quantity") > 25, "passed").otherwise("failed").alias("gate_status"),
    )


def _requests(t: Tables):
    return t.orders.select(F.col("o_orderkey").alias("dataset_version_id"), F.lit("gold").alias("target_layer"))


@query(
    "ln06_promotion",
    _CHECKS
    + """SELECT o_orderkey AS dataset_version_id, CASE WHEN any_passed THEN 'accepted' ELSE 'blocked' END AS outcome,
       CASE WHEN any_passed THEN NULL WHEN v IS NULL THEN 'no quality check' ELSE 'quality gate failed' END AS reason
       FROM orders LEFT JOIN s ON v = o_orderkey""",
)
def promotion(t: Tables):
    accepted, blocked = lineage.promote(_requests(t), _checks(t))
    accepted = accepted.withColumn("reason", F.lit(None).cast("string")).withColumn("outcome", F.lit("accepted"))
    both = accepted.unionByName(blocked.withColumn("outcome", F.lit("blocked")))
    return both.select("dataset_version_id", "outcome", "reason")


@query(
    "ln06_promotion_all_suites",
    _CHECKS + "SELECT v AS dataset_version_id, 'gold' AS target_layer FROM s JOIN orders ON v = o_orderkey WHERE any_passed AND NOT any_failed",
)
def promotion_all(t: Tables):
    accepted, _ = lineage.promote(_requests(t), _checks(t), require_all=True)
    return accepted


@query(
    "jn07_has_passing_check",
    "SELECT o_orderkey AS dataset_version_id FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 25)",
)
def passing(t: Tables):
    return lineage.passing_versions(_requests(t), _checks(t)).select("dataset_version_id")


@query(
    "jn07_lacks_passing_check",
    "SELECT o_orderkey AS dataset_version_id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 25)",
)
def lacking(t: Tables):
    return lineage.lacking_versions(_requests(t), _checks(t)).select("dataset_version_id")


@query(
    "ln05_quality_results",
    """SELECT year(o_orderdate)::BIGINT AS dataset_version_id, 'yearly' AS check_suite,
         CASE WHEN count(*) >= 2000 THEN 'passed' ELSE 'failed' END AS gate_status FROM orders GROUP BY 1""",
)
def results(t: Tables):
    yearly = t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("version")).agg(
        F.count("*").alias("total_processed"), F.count("*").alias("total_expected"),
        F.lit(100.0).alias("avg_token_count"), F.lit(0.5).alias("avg_lexical_diversity"),
    )
    judged = quality.quality_gate(yearly, quality.QualityThresholds(min_studies_processed=2000))
    return quality.quality_results(judged, "version", "yearly").drop("issues")


@query(
    "ln07_snapshot_delta",
    """WITH o AS (SELECT o_orderkey AS k, o_totalprice AS price, o_orderstatus AS status FROM orders WHERE o_orderkey % 10 <> 0),
       n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
         CASE WHEN o_orderkey % 14 = 0 THEN 'X' ELSE o_orderstatus END AS status FROM orders WHERE o_orderkey % 9 <> 0)
       SELECT coalesce(o.k, n.k) AS o_orderkey, CASE WHEN o.k IS NULL THEN 'inserted' WHEN n.k IS NULL THEN 'deleted'
         WHEN o.price <> n.price OR o.status <> n.status THEN 'updated' ELSE 'unchanged' END AS change,
         concat_ws(',', CASE WHEN o.price <> n.price THEN 'price' END, CASE WHEN o.status <> n.status THEN 'status' END) AS changed_columns
       FROM o FULL JOIN n ON o.k = n.k""",
)
def delta(t: Tables):
    k = F.col("o_orderkey")
    old = t.orders.filter(k % 10 != 0).select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    new = t.orders.filter(k % 9 != 0).select(
        "o_orderkey", F.when(k % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(k % 14 == 0, "X").otherwise(F.col("o_orderstatus")).alias("status"),
    )
    found = lineage.snapshot_delta(old, new, "o_orderkey")
    return found.withColumn("changed_columns", F.array_join("changed_columns", ","))


def _edges(t: Tables):
    """Every order derives from the order with half its number; order 1 also closes a cycle."""
    tree = t.orders.filter("o_orderkey > 0").select(
        F.floor(F.col("o_orderkey") / 2).alias("parent"), F.col("o_orderkey").alias("child")
    )
    return tree.unionByName(tree.agg(F.max("child").alias("parent"), F.lit(1).cast("bigint").alias("child")))


_EDGES = """WITH RECURSIVE tree AS (SELECT o_orderkey // 2 AS parent, o_orderkey AS child FROM orders WHERE o_orderkey > 0
  UNION ALL SELECT max(o_orderkey), 1 FROM orders),
"""


@query(
    "jn10_ln04_descendants",
    _EDGES
    + """walk AS (SELECT 1::BIGINT AS node, 0 AS depth UNION SELECT child, depth + 1 FROM walk JOIN tree ON parent = node WHERE depth < 25)
       SELECT node, min(depth)::BIGINT AS depth FROM walk GROUP BY 1""",
)
def descendants(t: Tables):
    start = t.orders.agg(F.lit(1).cast("bigint").alias("node"))
    found = lineage.lineage_closure(_edges(t), start, "down")
    return found.withColumn("depth", F.col("depth").cast("bigint"))


@query(
    "jn10_ln04_ancestors",
    _EDGES
    + """walk AS (SELECT max(o_orderkey) - 7 AS node, 0 AS depth FROM orders UNION SELECT parent, depth + 1 FROM walk JOIN tree ON child = node WHERE depth < 60)
       SELECT node, min(depth)::BIGINT AS depth FROM walk GROUP BY 1""",
)
def ancestors(t: Tables):
    start = t.orders.agg((F.max("o_orderkey") - 7).alias("node"))
    found = lineage.lineage_closure(_edges(t), start, "up")
    return found.withColumn("depth", F.col("depth").cast("bigint"))
