"""Statistics of fields, lists, records and JSON structure."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialspark.functions import scalars
from trialspark.operators import profile, quality
from trialspark.plans.registry import query
from trialspark.plans.tables import Tables


def _pairs(c: str):
    shown = F.transform(c, lambda e: F.concat_ws("=", e["value"].cast("string"), e["count"].cast("string")))
    return F.array_join(shown, ", ")


_FIELDS = ("overall_status", "study_type", "phase", "source_snapshot_id", "nct_id")


@query(
    "ag11_value_statistics",
    f"""WITH v AS (SELECT nct_id AS id, unnest([{', '.join(f"'{f}'" for f in _FIELDS)}]) AS field,
          unnest([{', '.join("CASE WHEN trial_id % 11 <> 0 THEN overall_status END" if f == 'overall_status' else f for f in _FIELDS)}]) AS value FROM trial),
        c AS (SELECT field, value, count(*) AS n, min(id) AS owner FROM v GROUP BY 1, 2),
        l AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY length(value) DESC, value) AS r FROM c WHERE value IS NOT NULL),
        m AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS r FROM c WHERE value IS NOT NULL),
        t AS (SELECT field, string_agg(concat(value, '=', n), ', ' ORDER BY r) AS top_values FROM m WHERE r <= 3 GROUP BY 1),
        s AS (SELECT field, coalesce(sum(n) FILTER (value IS NULL), 0)::BIGINT AS missing_count, count(value) AS unique_values FROM c GROUP BY 1)
        SELECT s.field, missing_count, unique_values, l.value AS longest_value, length(l.value)::BIGINT AS longest_length,
          l.owner AS longest_owner, top_values FROM s JOIN l ON s.field = l.field AND l.r = 1 JOIN t ON s.field = t.field""",
    "trial",
)
def values(t: Tables):
    df = t.trial.withColumn("overall_status", F.when(F.col("trial_id") % 11 != 0, F.col("overall_status")))
    found = profile.value_statistics(df, "nct_id", _FIELDS, top=3)
    return found.withColumns({"top_values": _pairs("top_values"), "longest_length": F.col("longest_length").cast("bigint")})


@query(
    "ag12_number_statistics",
    """SELECT 'latitude' AS field, min(latitude) AS min_value, max(latitude) AS max_value, round(avg(latitude), 6) AS avg_value,
         count(*) FILTER (latitude IS NULL) AS missing_count FROM site
       UNION ALL SELECT 'trial_id', min(trial_id)::DOUBLE, max(trial_id)::DOUBLE, round(avg(trial_id), 6), 0 FROM site""",
    "site",
)
def numbers(t: Tables):
    return profile.number_statistics(t.site, ["latitude", "trial_id"]).withColumn("avg_value", F.round("avg_value", 6))


@query(
    "ag13_date_statistics",
    """SELECT 'start_date' AS field, min(start_date) AS min_value, max(start_date) AS max_value,
         count(*) FILTER (start_date IS NULL) AS missing_count, 'other, yyyy-MM, yyyy-MM-dd' AS formats FROM raw_csv""",
    "raw_csv",
)
def dates(t: Tables):
    return profile.date_statistics(t.raw_csv, ["start_date"]).withColumn("formats", F.array_join("formats", ", "))


@query(
    "ag14_boolean_statistics",
    """SELECT 'has_results' AS field, count(*) FILTER (study_results = 'YES') AS true_count,
         count(*) FILTER (study_results = 'NO') AS false_count, count(*) FILTER (study_results IS NULL) AS missing_count FROM raw_csv""",
    "raw_csv",
)
def booleans(t: Tables):
    df = t.raw_csv.select(scalars.yes_flag("study_results").alias("has_results"))
    return profile.boolean_statistics(df, ["has_results"])


@query(
    "ag15_list_size_statistics",
    """WITH s AS (SELECT CASE WHEN trial_id % 10 = 0 THEN 0 ELSE count(*) END AS size FROM endpoint GROUP BY trial_id),
       c AS (SELECT size, count(*) AS n FROM s GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, size) AS r FROM c)
       SELECT 'endpoints' AS field, min(size)::BIGINT AS min_size, max(size)::BIGINT AS max_size, count(*) AS unique_sizes,
         string_agg(concat(size, '=', n), ', ' ORDER BY r) FILTER (r <= 5) AS top_sizes FROM r""",
    "endpoint",
)
def list_sizes(t: Tables):
    lists = t.endpoint.groupBy("trial_id").agg(F.collect_list("endpoint_name").alias("e"))
    empty = F.array().cast("array<string>")
    df = lists.select(F.when(F.col("trial_id") % 10 == 0, empty).otherwise(F.col("e")).alias("endpoints"))
    found = profile.list_size_statistics(df, ["endpoints"], top=5)
    longs = {c: F.col(c).cast("bigint") for c in ("min_size", "max_size")}
    return found.withColumns({"top_sizes": _pairs("top_sizes"), **longs})


@query(
    "ag16_record_sizes",
    """SELECT count(*) AS total_records, round(avg(strlen(text)), 6) AS average_bytes,
         round(quantile_cont(strlen(text), 0.5), 6) AS p50, round(quantile_cont(strlen(text), 0.75), 6) AS p75,
         round(quantile_cont(strlen(text), 0.9), 6) AS p90, round(quantile_cont(strlen(text), 0.95), 6) AS p95 FROM documents""",
)
def record_sizes(t: Tables):
    found = profile.record_size_statistics(t.documents, "text")
    return found.select("total_records", *[F.round(c, 6).alias(c) for c in found.columns if c != "total_records"])


@query(
    "ag16_record_size_ranges",
    """SELECT CASE WHEN strlen(text) < 10240 THEN '0-10KB' WHEN strlen(text) < 25600 THEN '10-25KB' WHEN strlen(text) < 51200 THEN '25-50KB'
         WHEN strlen(text) < 102400 THEN '50-100KB' ELSE '100KB+' END AS size_range, count(*) AS records FROM documents GROUP BY 1""",
)
def record_ranges(t: Tables):
    return profile.record_size_ranges(t.documents, "text")


@query(
    "sl05_largest_records",
    "SELECT doc_id, strlen(text)::BIGINT AS size_bytes FROM documents ORDER BY 2 DESC, 1 LIMIT 20",
)
def largest(t: Tables):
    found = profile.largest_records(t.documents, "doc_id", "text", 20)
    return found.withColumn("size_bytes", F.col("size_bytes").cast("bigint"))


@query(
    "ag17_top_level_keys",
    """SELECT key, count(*) AS records, round(count(*) / (SELECT count(*) FROM raw_json) * 100, 6) AS percentage
       FROM (SELECT unnest(json_keys(study_json)) AS key FROM raw_json) GROUP BY 1""",
    "raw_json",
)
def top_level(t: Tables):
    return profile.top_level_keys(t.raw_json, "study_json").withColumn("percentage", F.round("percentage", 6))


@query(
    "sc23_json_key_paths",
    """SELECT nct_id, array_to_string(list_sort(list_concat(['hasResults', 'protocolSection',
         'protocolSection.conditionsModule', 'protocolSection.conditionsModule.conditions', 'protocolSection.designModule',
         'protocolSection.designModule.enrollmentInfo', 'protocolSection.designModule.enrollmentInfo.count',
         'protocolSection.designModule.phases', 'protocolSection.identificationModule', 'protocolSection.identificationModule.nctId'],
         CASE WHEN json_exists(study_json, '$.protocolSection.identificationModule.officialTitle')
           THEN ['protocolSection.identificationModule.officialTitle'] ELSE [] END)), ' ') AS paths FROM raw_json""",
    "raw_json",
)
def key_paths(t: Tables):
    found = profile.json_key_paths(t.raw_json, "nct_id", "study_json")
    return found.select("nct_id", F.array_join("paths", " ").alias("paths"))


def _fetched(t: Tables):
    """A second copy of the studies: some lack the title, some are absent, some have a new section."""
    number = F.substring("nct_id", 4, 8).cast("bigint")
    text = F.when(number % 3 == 0, F.regexp_replace("study_json", ',"officialTitle":"[^"]*"', "")).otherwise(F.col("study_json"))
    text = F.when(number % 5 == 0, F.regexp_replace(text, r"^\{", '{"resultsSection":{"n":[{"a":1}]},')).otherwise(text)
    return t.raw_json.filter(number % 7 != 0).select("nct_id", text.alias("study_json"))


_FETCHED = r"""
WITH f AS (SELECT nct_id, substr(nct_id, 4, 8)::BIGINT AS k, study_json AS a,
    contains(study_json, 'officialTitle') AND substr(nct_id, 4, 8)::BIGINT % 3 = 0 AS lost, substr(nct_id, 4, 8)::BIGINT % 5 = 0 AS added FROM raw_json),
g AS (SELECT *, CASE WHEN lost THEN regexp_replace(a, ',"officialTitle":"[^"]*"', '') ELSE a END AS b0 FROM f),
h AS (SELECT *, strlen(a) AS sa, strlen(CASE WHEN added THEN concat('{"resultsSection":{"n":[{"a":1}]},', substr(b0, 2)) ELSE b0 END) AS sb FROM g)
"""


@query(
    "jn12_so05_sc24_compare_snapshots",
    _FETCHED
    + """SELECT nct_id, CASE WHEN k % 7 = 0 THEN 'missing in fetched' ELSE 'compared' END AS status,
         CASE WHEN k % 7 <> 0 THEN CASE WHEN added THEN 3 ELSE 0 END END::BIGINT AS missing_in_local,
         CASE WHEN k % 7 <> 0 THEN lost::INT END::BIGINT AS missing_in_fetched,
         CASE WHEN k % 7 <> 0 THEN round(abs(sa - sb) / greatest(sa, sb) * 100, 2) END AS size_difference_pct FROM h""",
    "raw_json",
)
def compare(t: Tables):
    found = profile.compare_snapshots(t.raw_json, _fetched(t), "nct_id", "study_json")
    longs = [F.col(c).cast("bigint").alias(c) for c in ("missing_in_local", "missing_in_fetched")]
    return found.select("nct_id", "status", "size_difference_pct", *longs)


@query(
    "ag18_structure_summary",
    _FETCHED
    + """SELECT count(*) AS compared, round(avg(round(abs(sa - sb) / greatest(sa, sb) * 100, 2)), 4) AS avg_size_difference_pct,
         round(avg(CASE WHEN added THEN 3 ELSE 0 END), 6) AS avg_missing_in_local, round(avg(lost::INT), 6) AS avg_missing_in_fetched,
         true AS local_consistent, false AS fetched_consistent FROM h WHERE k % 7 <> 0""",
    "raw_json",
)
def summary(t: Tables):
    found = profile.structure_summary(profile.compare_snapshots(t.raw_json, _fetched(t), "nct_id", "study_json"))
    places = {"avg_size_difference_pct": 4, "avg_missing_in_local": 6, "avg_missing_in_fetched": 6}
    return found.withColumns({c: F.round(c, n) for c, n in places.items()})


def _statuses(t: Tables):
    """Page downloads with an outcome: the page is the document."""
    n = F.col("page_id")
    status = F.when(n % 4 == 0, "failed").when(n % 4 == 1, "skipped").otherwise("downloaded")
    return t.pages.select(
        F.concat(F.lit("NCT"), (n % 100).cast("string")).alias("nct_id"), status.alias("status"),
        F.when(n % 4 != 0, F.octet_length("html").cast("bigint")).alias("file_size"),
    )


_STATUS = """WITH d AS (SELECT page_id % 100 AS study, CASE page_id % 4 WHEN 0 THEN 'failed' WHEN 1 THEN 'skipped' ELSE 'downloaded' END AS status,
  CASE WHEN page_id % 4 <> 0 THEN strlen(html) END AS file_size FROM pages)
"""


@query(
    "ag05_document_statistics",
    _STATUS
    + """SELECT count(*) AS total_documents, count(*) FILTER (status = 'downloaded') AS downloaded, count(*) FILTER (status = 'failed') AS failed,
       count(*) FILTER (status = 'skipped') AS skipped, round(sum(file_size) FILTER (status = 'downloaded') / 1048576.0, 6) AS total_size_mb,
       count(DISTINCT study) AS studies_with_documents FROM d""",
)
def document_statistics(t: Tables):
    found = quality.document_statistics(_statuses(t))
    return found.withColumn("total_size_mb", F.round("total_size_mb", 6))


@query(
    "ag06_snapshot_summary",
    _STATUS
    + """SELECT 'snapshot-1' AS snapshot_id, count(*) AS document_count, count(*) FILTER (status = 'downloaded') AS downloaded_count,
       count(*) FILTER (status = 'skipped') AS skipped_count, count(*) FILTER (status = 'failed') AS failed_count,
       count(DISTINCT study) AS studies_with_documents, coalesce(sum(file_size), 0)::BIGINT AS total_size_bytes FROM d""",
)
def snapshot_summary(t: Tables):
    return quality.snapshot_summary(_statuses(t), "snapshot-1")


@query(
    "ag07_quality_gate",
    r"""WITH w AS (SELECT len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS n, len(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS u FROM documents),
       m AS (SELECT count(*) AS total_processed, avg(n) AS tokens, avg(CASE WHEN n > 0 THEN u / n ELSE 0 END) AS diversity FROM w),
       e AS (SELECT (SELECT count(*) FROM orders) AS total_expected, * FROM m)
       SELECT total_expected, total_processed, total_processed AS nlp_processed, (SELECT count(embedding) FROM embeddings) AS embeddings_generated,
         round(tokens, 6) AS avg_token_count, round(diversity, 6) AS avg_lexical_diversity,
         round(total_processed / total_expected * 100, 6) AS processing_rate, round(1 - total_processed / total_expected, 6) AS error_rate,
         total_processed >= 500 AND 1 - total_processed / total_expected <= 0.05 AS passed,
         concat_ws('; ', CASE WHEN total_processed < 500 THEN 'total_processed' END,
           CASE WHEN 1 - total_processed / total_expected > 0.05 THEN 'error_rate' END,
           CASE WHEN tokens < 100000 THEN 'avg_token_count' END, CASE WHEN diversity < 0.1 THEN 'avg_lexical_diversity' END) AS issues FROM e""",
)
def gate(t: Tables):
    from trialspark.functions.text import tokens

    counted = t.documents.select(tokens("text").alias("w")).select(
        F.size("w").alias("token_count"),
        F.when(F.size("w") > 0, F.size(F.array_distinct("w")) / F.size("w")).otherwise(0.0).alias("lexical_diversity"),
    )
    metrics = quality.quality_metrics(t.orders, t.documents, counted, t.embeddings)
    limits = quality.QualityThresholds(min_studies_processed=500, min_avg_tokens=100_000)
    judged = quality.quality_gate(metrics, limits)
    rounded = {c: F.round(c, 6) for c in ("avg_token_count", "avg_lexical_diversity", "processing_rate", "error_rate")}
    return judged.withColumns(rounded).withColumn("issues", F.array_join("issues.metric", "; "))


@query("ag09_status_trend", "SELECT overall_status, count(*) AS trials FROM trial GROUP BY 1", "trial")
def status_trend(t: Tables):
    return quality.status_trend(t.trial)


@query(
    "ag10_publications_by_journal",
    "SELECT journal, count(*) AS publications FROM publication GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
    "publication",
)
def journals(t: Tables):
    return quality.publications_by_journal(t.publication)


@query("ag24_counts_by_category", "SELECT country, count(*) AS n FROM site GROUP BY 1", "site")
def by_category(t: Tables):
    return quality.counts_by(t.site, "country")


_LOG = """WITH log AS (SELECT ts, user_id % 7 AS hops, round(value / 40, 2) AS latency_s FROM events),
recent AS (SELECT * FROM log WHERE ts <= TIMESTAMP '2024-01-30 00:00:00' AND ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 30 DAYS),
multi AS (SELECT * FROM recent WHERE hops >= 4),
weeks AS (SELECT date_trunc('week', ts)::DATE AS week, quantile_cont(latency_s, 0.95) AS p95, count(*) AS queries FROM multi GROUP BY 1)
"""


def _log(t: Tables):
    return t.events.select("ts", (F.col("user_id") % 7).alias("hops"), F.round(F.col("value") / 40, 2).alias("latency_s"))


@query(
    "ag22_decision_gates",
    _LOG
    + """, slow AS (SELECT week FROM weeks WHERE p95 > 2.5), m AS (SELECT count(*) AS reads, count(*) FILTER (hops >= 4) / count(*) AS share FROM recent),
       runs AS (SELECT count(*) AS n FROM slow a JOIN slow b ON b.week = a.week - INTERVAL 7 DAYS)
       SELECT reads, round(share, 6) AS multi_hop_share, round((SELECT quantile_cont(latency_s, 0.95) FROM multi), 6) AS path_latency_p95,
         runs.n AS slow_week_runs, share >= 0.25 AS multi_hop_share_pass, runs.n > 0 AS path_latency_p95_pass, true AS complex_queries_pass,
         false AS blocked_features_pass, true AS explainability_share_pass, false AS retrieval_lift_pass,
         (share >= 0.25)::BIGINT + (runs.n > 0)::BIGINT + 2 AS gates_passed,
         CASE WHEN (share >= 0.25)::INT + (runs.n > 0)::INT + 2 >= 4 AND runs.n > 0 THEN 'go' ELSE 'no-go' END AS decision
       FROM m, runs""",
)
def gates(t: Tables):
    signals = quality.workload_signals(_log(t), "2024-01-30 00:00:00")
    reported = {"complex_queries": 25, "blocked_features": 1, "explainability_share": 0.5, "retrieval_lift": 0.05}
    decided = quality.decide_gates(signals, reported)
    rounded = {c: F.round(c, 6) for c in ("multi_hop_share", "path_latency_p95")}
    return decided.withColumns(rounded).withColumn("gates_passed", F.col("gates_passed").cast("bigint"))


@query(
    "ag22_weekly_latency",
    _LOG + "SELECT strftime(week, '%Y-%m-%d') AS week, round(p95, 6) AS p95, queries FROM weeks",
)
def weekly(t: Tables):
    recent = _log(t).filter("hops >= 4 and ts <= timestamp_ntz'2024-01-30 00:00:00' and ts > timestamp_ntz'2023-12-31 00:00:00'")
    found = quality.weekly_latency(recent, "ts", "latency_s")
    return found.select(F.col("week").cast("string").alias("week"), F.round("p95", 6).alias("p95"), "queries")
