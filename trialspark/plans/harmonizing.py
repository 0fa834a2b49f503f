"""Standardizing, validating and harmonizing the CSV and JSON studies."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from trialspark.functions import scalars
from trialspark.operators import flatten, harmonize, quality, validate
from trialspark.plans.registry import query
from trialspark.plans.tables import Tables
from trialspark.sources.studies import load_studies, restrict_to

RUN_TS = datetime(2024, 1, 1, tzinfo=timezone.utc)


def listed(c):
    """A list as text, so that engines compare it alike."""
    return F.coalesce(F.array_join(c, "|"), F.lit("<null>"))


def flat_studies(t: Tables):
    good, _ = load_studies(t.raw_json)
    return flatten.flatten_studies(good)


def harmonized(t: Tables, strategy: str, **options):
    return harmonize.harmonize(t.csv_with_headers(), flat_studies(t), strategy, RUN_TS, **options)


# Studies as DuckDB sees them, from the rules and not from the Spark plan.
SIDES = r"""
WITH csv AS (
  SELECT nct_number AS nct_id, study_title AS title, study_status AS overall_status,
    lower(study_results) IN ('yes', 'true', '1') AS has_results,
    string_split(conditions, '|') AS conditions,
    CASE WHEN regexp_full_match(enrollment, '[+-]?\d+') THEN enrollment::BIGINT END AS enrollment,
    coalesce(try_strptime(start_date, '%B %d, %Y'), try_strptime(start_date, '%Y-%m-%d'),
             try_strptime(start_date, '%m/%d/%Y'))::DATE AS start_date
  FROM raw_csv),
js AS (
  SELECT nct_id AS json_id,
    json_extract_string(study_json, '$.protocolSection.identificationModule.officialTitle') AS official,
    json_extract(study_json, '$.protocolSection.conditionsModule.conditions')::VARCHAR[] AS jconditions,
    json_extract(study_json, '$.protocolSection.designModule.phases')::VARCHAR[] AS phases,
    json_extract(study_json, '$.protocolSection.designModule.enrollmentInfo.count')::BIGINT AS jenrollment,
    json_extract_string(study_json, '$.hasResults') = 'true' AS jresults
  FROM raw_json),
both_sides AS (
  SELECT coalesce(nct_id, json_id) AS id, * FROM csv FULL JOIN js ON nct_id = json_id)
"""

_SHOWN = [
    "nct_id", "title", "official_title", "brief_title", "overall_status", "has_results", "enrollment", "data_source",
    "shard_hash",
]


def _shown(df):
    return df.select(
        *_SHOWN,
        listed("conditions").alias("conditions"),
        listed("interventions").alias("interventions"),
        F.col("start_date").cast("string").alias("start_date"),
    )


def _oracle(official, conditions, status, enrollment, source, brief="title", interventions="json_id IS NOT NULL"):
    return SIDES + f"""
    SELECT id AS nct_id, title, {official} AS official_title, {brief} AS brief_title,
      {status} AS overall_status, jresults AS has_results, {enrollment} AS enrollment,
      {source} AS data_source, concat('0x', substr(md5(id), 1, 8))::BIGINT AS shard_hash,
      coalesce(array_to_string({conditions}, '|'), '<null>') AS conditions,
      CASE WHEN json_id IS NOT NULL THEN '' ELSE '<null>' END AS interventions,
      strftime(start_date, '%Y-%m-%d') AS start_date
    FROM both_sides"""


@query(
    "prj01_prj02_standardize_csv",
    SIDES
    + """SELECT nct_id, title, overall_status, has_results, array_to_string(conditions, '|') AS conditions,
      len(conditions) AS n_conditions, enrollment, strftime(start_date, '%Y-%m-%d') AS start_date FROM csv""",
    "raw_csv raw_json",
)
def standardize_csv(t: Tables):
    df = harmonize.standardize_csv(t.csv_with_headers())
    return df.select(
        "nct_id", "title", "overall_status", "has_results", listed("conditions").alias("conditions"),
        F.size("conditions").cast("bigint").alias("n_conditions"), "enrollment",
        F.col("start_date").cast("string").alias("start_date"),
    )


@query(
    "prj03_prj04_enforced_schema",
    SIDES
    + """SELECT id AS nct_id, NULL::VARCHAR AS study_url, NULL::BOOLEAN AS healthy_volunteers,
      NULL::VARCHAR AS maximum_age, concat('0x', substr(md5(id), 1, 8))::BIGINT AS shard_hash,
      1704067200000000::BIGINT AS processed_us, 33::BIGINT AS n_columns FROM both_sides""",
    "raw_csv raw_json",
)
def enforced_schema(t: Tables):
    df = harmonized(t, "json_priority")
    return df.select(
        "nct_id", "study_url", "healthy_volunteers", "maximum_age", "shard_hash",
        F.unix_micros("processing_timestamp").alias("processed_us"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )


@query(
    "prj05_flatten_studies",
    SIDES
    + """SELECT json_id AS json_nct_id, official AS json_official_title, jresults AS json_has_results,
      array_to_string(list_transform(phases, lambda p: replace(p, 'PHASE', 'PHASE_')), '|') AS json_phases,
      array_to_string(jconditions, '|') AS json_conditions, len(jconditions) AS n_conditions,
      jenrollment AS json_enrollment, 0::BIGINT AS n_interventions, NULL::VARCHAR AS json_sex FROM js""",
    "raw_csv raw_json",
)
def flatten_json(t: Tables):
    return flat_studies(t).select(
        "json_nct_id", "json_official_title", "json_has_results", listed("json_phases").alias("json_phases"),
        listed("json_conditions").alias("json_conditions"),
        F.size("json_conditions").cast("bigint").alias("n_conditions"), "json_enrollment",
        F.size("json_interventions").cast("bigint").alias("n_interventions"), "json_sex",
    )


@query(
    "prj06_json_priority",
    _oracle(
        "coalesce(official, title)",
        "coalesce(jconditions, conditions)",
        "overall_status",
        "coalesce(jenrollment, enrollment)",
        "CASE WHEN official IS NOT NULL THEN 'json_priority' ELSE 'csv_only' END",
    ),
    "raw_csv raw_json",
)
def json_priority(t: Tables):
    return _shown(harmonized(t, "json_priority"))


@query(
    "prj07_csv_priority",
    _oracle(
        "coalesce(title, official)",
        "coalesce(conditions, jconditions)",
        "overall_status",
        "coalesce(enrollment, jenrollment)",
        "CASE WHEN title IS NOT NULL THEN 'csv_priority' ELSE 'json_only' END",
    ),
    "raw_csv raw_json",
)
def csv_priority(t: Tables):
    return _shown(harmonized(t, "csv_priority"))


@query(
    "prj08_merge_all",
    _oracle(
        "coalesce(official, title)",
        "CASE WHEN conditions IS NOT NULL AND jconditions IS NOT NULL "
        "THEN list_sort(list_distinct(list_concat(jconditions, conditions))) "
        "ELSE coalesce(jconditions, conditions) END",
        "overall_status",
        "coalesce(jenrollment, enrollment)",
        "CASE WHEN official IS NULL THEN 'csv_only' WHEN title IS NULL THEN 'json_only' ELSE 'merged' END",
    ),
    "raw_csv raw_json",
)
def merge_all(t: Tables):
    return _shown(harmonized(t, "merge_all"))


@query(
    "prj08_preserved_originals",
    SIDES
    + """SELECT id AS nct_id, title AS csv_title, official AS json_official_title_preserved,
      overall_status AS csv_overall_status, enrollment AS csv_enrollment,
      coalesce(jenrollment, enrollment) AS enrollment FROM both_sides""",
    "raw_csv raw_json",
)
def preserved(t: Tables):
    joined = harmonize.join_sources(harmonize.standardize_csv(t.csv_with_headers()), flat_studies(t))
    return harmonize.coalesce_sources(joined, "merge_all").select(
        "nct_id", "csv_title", "json_official_title_preserved", "csv_overall_status", "csv_enrollment", "enrollment"
    )


@query(
    "prj09_source_labels",
    SIDES
    + """SELECT 'json_priority' AS strategy, CASE WHEN official IS NOT NULL THEN 'json_priority' ELSE 'csv_only' END
        AS data_source, count(*) AS studies FROM both_sides GROUP BY 2
      UNION ALL SELECT 'csv_priority', CASE WHEN title IS NOT NULL THEN 'csv_priority' ELSE 'json_only' END, count(*)
        FROM both_sides GROUP BY 2
      UNION ALL SELECT 'merge_all', CASE WHEN official IS NULL THEN 'csv_only' WHEN title IS NULL THEN 'json_only'
        ELSE 'merged' END, count(*) FROM both_sides GROUP BY 2""",
    "raw_csv raw_json",
)
def source_labels(t: Tables):
    joined = harmonize.join_sources(harmonize.standardize_csv(t.csv_with_headers()), flat_studies(t))
    labels = F.array(
        *[
            F.struct(F.lit(s).alias("strategy"), harmonize._source_label(s).alias("data_source"))
            for s in harmonize.STRATEGIES
        ]
    )
    labelled = joined.select(F.inline(labels))
    return labelled.groupBy("strategy", "data_source").agg(F.count("*").alias("studies"))


@query(
    "prj10_derived_flags",
    SIDES
    + """SELECT id AS nct_id, 0::BIGINT AS document_count, official IS NOT NULL AS has_json_data,
      false AS is_interventional, coalesce(overall_status = 'RECRUITING', false) AS is_recruiting FROM both_sides""",
    "raw_csv raw_json",
)
def derived_flags(t: Tables):
    return harmonize.with_derived_flags(harmonized(t, "json_priority")).select(
        "nct_id", F.col("document_count").cast("bigint").alias("document_count"), "has_json_data",
        "is_interventional", "is_recruiting",
    )


@query(
    "prj11_phases",
    """SELECT o_orderkey, concat('PHASE_', 1 + o_orderkey % 4, '|EARLY_PHASE_1|NA|PHASE_1_PHASE_2|NA') AS phases
       FROM orders""",
)
def phases(t: Tables):
    raw = F.array(
        F.concat(F.lit("phase "), (1 + F.col("o_orderkey") % 4).cast("string")),
        F.lit("Early Phase 1"), F.lit("n/a"), F.lit("PHASE_1 PHASE_2"), F.col("o_orderpriority"),
    )
    return t.orders.select("o_orderkey", listed(flatten.normalize_phases(raw)).alias("phases"))


@query(
    "prj12_restrict_to_ids",
    "SELECT nct_number, study_title FROM raw_csv WHERE nct_number IN (SELECT nct_id FROM raw_json)",
    "raw_csv raw_json",
)
def restricted(t: Tables):
    ids = t.raw_json.select(F.col("nct_id").alias("nct_number"))
    return restrict_to(t.raw_csv, ids, "nct_number").select("nct_number", "study_title")


@query(
    "jn01_full_outer_join",
    SIDES
    + """SELECT id AS nct_id, nct_id IS NOT NULL AS in_csv, json_id IS NOT NULL AS in_json, enrollment, jenrollment
       AS json_enrollment FROM both_sides""",
    "raw_csv raw_json",
)
def full_join(t: Tables):
    csv = harmonize.standardize_csv(t.csv_with_headers()).withColumn("in_csv", F.lit(True))
    joined = harmonize.join_sources(csv, flat_studies(t))
    return joined.select(
        "nct_id", F.coalesce("in_csv", F.lit(False)).alias("in_csv"),
        F.col("json_has_results").isNotNull().alias("in_json"), "enrollment", "json_enrollment",
    )


def _keys(t: Tables):
    return t.raw_csv.select(F.col("nct_number").alias("nct_id")), t.raw_json.select("nct_id")


@query(
    "ag01_overlap_statistics",
    SIDES
    + """SELECT count(nct_id) AS csv_total, count(json_id) AS json_total,
      count(*) FILTER (nct_id IS NOT NULL AND json_id IS NOT NULL) AS overlap_count,
      count(*) FILTER (json_id IS NULL) AS csv_only_count, count(*) FILTER (nct_id IS NULL) AS json_only_count,
      round(count(*) FILTER (nct_id IS NOT NULL AND json_id IS NOT NULL) / count(nct_id) * 100, 6) AS overlap_percentage
      FROM both_sides""",
    "raw_csv raw_json",
)
def overlap(t: Tables):
    stats = harmonize.overlap_statistics(*_keys(t), "nct_id")
    return stats.withColumn("overlap_percentage", F.round("overlap_percentage", 6))


@query(
    "ag02_harmonization_statistics",
    SIDES
    + """SELECT count(nct_id) AS csv_study_count, count(json_id) AS json_study_count,
      count(*) FILTER (nct_id IS NOT NULL AND json_id IS NOT NULL) AS overlap_count,
      count(*) FILTER (json_id IS NULL) AS csv_only_count, count(*) FILTER (nct_id IS NULL) AS json_only_count,
      count(*) AS harmonized_count, 0::BIGINT AS document_url_count,
      round(count(*) FILTER (nct_id IS NOT NULL AND json_id IS NOT NULL) / count(nct_id) * 100, 6) AS overlap_percentage,
      round(count(json_id) / count(nct_id) * 100, 6) AS json_coverage_percentage FROM both_sides""",
    "raw_csv raw_json",
)
def statistics(t: Tables):
    csv = harmonize.standardize_csv(t.csv_with_headers())
    stats = harmonize.harmonization_statistics(csv, flat_studies(t), harmonized(t, "json_priority"))
    rounded = {c: F.round(c, 6) for c in ("overlap_percentage", "json_coverage_percentage")}
    return stats.withColumns(rounded)


@query(
    "so01_so02_so03_key_sets",
    """SELECT nct_id, bool_or(a) AS in_a, bool_or(b) AS in_b FROM (
         SELECT nct_number AS nct_id, true AS a, false AS b FROM raw_csv
         UNION ALL SELECT nct_id, false, true FROM raw_json) GROUP BY 1""",
    "raw_csv raw_json",
)
def key_sets(t: Tables):
    return harmonize.key_overlap(*_keys(t), "nct_id")


@query(
    "so01_keys_in_both",
    "SELECT nct_number AS nct_id FROM raw_csv INTERSECT SELECT nct_id FROM raw_json",
    "raw_csv raw_json",
)
def keys_in_both(t: Tables):
    return harmonize.key_overlap(*_keys(t), "nct_id").filter("in_a and in_b").select("nct_id")


@query(
    "so02_keys_only_in_csv",
    "SELECT nct_number AS nct_id FROM raw_csv EXCEPT SELECT nct_id FROM raw_json",
    "raw_csv raw_json",
)
def keys_only_in_csv(t: Tables):
    return harmonize.key_overlap(*_keys(t), "nct_id").filter("in_a and not in_b").select("nct_id")


@query(
    "sc01_sc02_pipe_lists",
    """SELECT o_orderkey, concat_ws('/', o_orderpriority, ' ', '', o_orderstatus) AS raw_parts, 4::BIGINT AS n_raw,
         concat_ws('/', o_orderpriority, o_orderstatus) AS clean_parts, 2::BIGINT AS n_clean FROM orders""",
)
def pipe_lists(t: Tables):
    piped = F.concat_ws("|", "o_orderpriority", F.lit(" "), F.lit(""), "o_orderstatus")
    raw, clean = scalars.pipe_list(piped), scalars.pipe_list(piped, clean=True)
    return t.orders.select(
        "o_orderkey", F.array_join(raw, "/").alias("raw_parts"), F.size(raw).cast("bigint").alias("n_raw"),
        F.array_join(clean, "/").alias("clean_parts"), F.size(clean).cast("bigint").alias("n_clean"),
    )


@query(
    "sc03_extract_urls",
    r"""SELECT page_id, array_to_string(regexp_extract_all(concat('see ', url, ', ', html), 'https?://[^\s,]+'), ' ')
          AS urls FROM pages""",
)
def urls(t: Tables):
    text = F.concat(F.lit("see "), "url", F.lit(", "), "html")
    return t.pages.select("page_id", F.array_join(scalars.extract_urls(text), " ").alias("urls"))


def _documents(t: Tables):
    typed = F.concat(F.lit("Protocol "), F.col("page_id").cast("string"), F.lit(", "), F.col("url"))
    entry = F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(typed)
    studies = t.pages.select(
        F.concat(F.lit("NCT"), F.lpad(F.col("page_id").cast("string"), 8, "0")).alias("nct_id"),
        F.when(F.col("page_id") % 5 != 0, F.array(entry, F.concat("url", F.lit("/files/Plan.PDF?v=1")))).otherwise(
            F.array().cast("array<string>")
        ).alias("document_urls"),
    )
    return quality.explode_documents(studies, "snapshot-1")


_DUCK_DOCUMENTS = r"""
WITH entries AS (
  SELECT concat('NCT', lpad(page_id::VARCHAR, 8, '0')) AS nct_id,
    unnest([CASE WHEN page_id % 3 = 0 THEN url ELSE concat('Protocol ', page_id, ', ', url) END,
            concat(url, '/files/Plan.PDF?v=1')]) AS entry
  FROM pages WHERE page_id % 5 <> 0),
documents_of AS (
  SELECT nct_id,
    CASE WHEN contains(entry, ', http') THEN trim(split_part(entry, ', http', 1)) ELSE 'Unknown Document' END AS document_type,
    CASE WHEN contains(entry, ', http') THEN trim(substr(entry, instr(entry, ', http') + 2)) ELSE trim(entry) END AS url
  FROM entries),
named AS (
  SELECT *, regexp_replace(regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '^https?://[^/]*', ''), '/+$', '') AS path
  FROM documents_of),
files AS (
  SELECT nct_id, document_type, url,
    CASE WHEN path = '' THEN 'unknown_document.pdf' ELSE list_last(string_split(path, '/')) END AS filename FROM named)
"""


@query(
    "sc04_sc05_sc07_explode_documents",
    _DUCK_DOCUMENTS
    + "SELECT nct_id, document_type, url, filename, 'pending' AS status, 'snapshot-1' AS source_snapshot_id FROM files",
)
def exploded_documents(t: Tables):
    return _documents(t).select("nct_id", "document_type", "url", "filename", "status", "source_snapshot_id")


@query(
    "sc06_safe_filename",
    r"""SELECT page_id, regexp_replace(url, '[^\w\-.]', '_', 'g') AS safe_name FROM pages""",
)
def safe_names(t: Tables):
    return t.pages.select("page_id", scalars.safe_filename("url").alias("safe_name"))


@query(
    "val06_document_typing",
    _DUCK_DOCUMENTS
    + """SELECT nct_id, url, CASE WHEN contains(filename, '.') THEN lower(list_last(string_split(filename, '.'))) END
           AS file_extension, coalesce(contains(filename, '.') AND lower(list_last(string_split(filename, '.'))) = 'pdf',
           false) AS is_pdf FROM files""",
)
def document_typing(t: Tables):
    extension = scalars.file_extension("filename", "url")
    return _documents(t).select(
        "nct_id", "url", extension.alias("file_extension"), F.coalesce(extension == "pdf", F.lit(False)).alias("is_pdf")
    )


_DATE_TEXT = {
    0: "strftime(o_orderdate, '%Y-%m-%d')",
    1: "strftime(o_orderdate, '%B %d, %Y')",
    2: "strftime(o_orderdate, '%m/%d/%Y')",
    3: "strftime(o_orderdate, '%Y-%m')",
    4: "strftime(o_orderdate, '%d-%b-%Y')",
    5: "strftime(o_orderdate, '%Y/%m/%d')",
}
_DATE_FORMATS = ["yyyy-MM-dd", "MMMM dd, yyyy", "MM/dd/yyyy", "yyyy-MM", "dd-MMM-yyyy", "yyyy/MM/dd"]


@query(
    "sc11_sc12_date_parsers",
    f"""WITH texts AS (SELECT o_orderkey, o_orderdate::DATE AS d, o_orderkey % 7 AS k, CASE o_orderkey % 7
          {' '.join(f"WHEN {k} THEN {v}" for k, v in _DATE_TEXT.items())} ELSE 'soon' END AS date_text FROM orders)
        SELECT o_orderkey, date_text, CASE WHEN k <= 2 THEN strftime(d, '%Y-%m-%d') END AS pipeline_date,
          CASE WHEN k = 3 THEN strftime(date_trunc('month', d), '%Y-%m-%d')
               WHEN k <= 5 THEN strftime(d, '%Y-%m-%d') END AS record_date FROM texts""",
)
def date_parsers(t: Tables):
    kind = F.col("o_orderkey") % 7
    text = F.when(kind == 0, F.date_format("o_orderdate", _DATE_FORMATS[0]))
    for k, fmt in enumerate(_DATE_FORMATS[1:], start=1):
        text = text.when(kind == k, F.date_format("o_orderdate", fmt))
    df = t.orders.select("o_orderkey", text.otherwise("soon").alias("date_text"))
    return df.select(
        "o_orderkey", "date_text", scalars.parse_date3("date_text").cast("string").alias("pipeline_date"),
        scalars.parse_date_flexible("date_text").cast("string").alias("record_date"),
    )


@query(
    "sc13_partial_dates",
    """SELECT nct_number, CASE WHEN length(start_date) = 10 AND start_date[5] = '-' THEN start_date
         WHEN length(start_date) = 7 THEN concat(start_date, '-01') END AS value,
         CASE WHEN length(start_date) = 10 AND start_date[5] = '-' THEN 'day' WHEN length(start_date) = 7 THEN 'month' END
         AS date_precision FROM raw_csv""",
    "raw_csv",
)
def partial_dates(t: Tables):
    part = scalars.partial_date("start_date")
    return t.raw_csv.select(
        "nct_number", part["value"].cast("string").alias("value"), part["precision"].alias("date_precision")
    )


@query(
    "sc14_sc15_flags_and_integers",
    """SELECT nct_number, study_results = 'YES' AS flag, CASE WHEN enrollment <> 'n/a' THEN enrollment::BIGINT END
         AS number, start_date LIKE 'x%' OR NULL AS never FROM raw_csv""",
    "raw_csv",
)
def flags_and_integers(t: Tables):
    return t.raw_csv.select(
        "nct_number", scalars.yes_flag("study_results").alias("flag"), scalars.try_int("enrollment").alias("number"),
        F.lit(None).cast("boolean").alias("never"),
    )


@query(
    "sc16_hashes",
    """SELECT doc_id, sha256(text) AS sha256_hex, md5(text) AS md5_hex,
         concat('0x', substr(md5(text), 1, 8))::BIGINT AS shard FROM documents""",
)
def hashes(t: Tables):
    return t.documents.select(
        "doc_id", F.sha2("text", 256).alias("sha256_hex"), F.md5("text").alias("md5_hex"),
        scalars.shard_hash("text").alias("shard"),
    )


@query(
    "sc17_age_years",
    """SELECT p_partkey, round(CASE p_partkey % 4 WHEN 0 THEN p_size::DOUBLE WHEN 1 THEN p_size / 12.0
         WHEN 2 THEN p_size * 7 / 365.25 ELSE NULL END, 6) AS age FROM part""",
)
def ages(t: Tables):
    size = F.col("p_size").cast("string")
    text = (
        F.when(F.col("p_partkey") % 4 == 0, F.concat(size, F.lit(" Years")))
        .when(F.col("p_partkey") % 4 == 1, F.concat(size, F.lit(" month")))
        .when(F.col("p_partkey") % 4 == 2, F.concat(size, F.lit(" weeks")))
        .otherwise("N/A")
    )
    return t.part.select("p_partkey", F.round(scalars.age_years(text), 6).alias("age"))


@query(
    "sc18_year_and_length",
    """SELECT o_orderkey, year(o_orderdate)::BIGINT AS order_year, length(o_orderpriority)::BIGINT AS text_length
       FROM orders""",
)
def year_and_length(t: Tables):
    both = scalars.year_and_length(F.col("o_orderdate").cast("date"), "o_orderpriority")
    return t.orders.select(
        "o_orderkey", both["year"].cast("bigint").alias("order_year"), both["text_length"].cast("bigint").alias("text_length")
    )


@query(
    "sc22_json_attributes",
    """SELECT event_id, json_extract(attributes, '$.k')::BIGINT AS k, NULL::VARCHAR AS absent,
         json_extract(attributes, '$.k')::BIGINT = 5 AS is_five FROM updates""",
    "updates",
)
def attributes(t: Tables):
    k = scalars.attribute("attributes", "$.k", "bigint")
    return t.updates.select(
        "event_id", k.alias("k"), scalars.attribute("attributes", "$.none", "string").alias("absent"), (k == 5).alias("is_five")
    )


@query(
    "val01_validate_csv",
    """WITH checked AS (
         SELECT coalesce(enrollment = 'n/a', false) AS bad_number, o.o_orderkey % 13 = 0 AS bad_id,
           o.o_orderkey % 17 = 0 AS bad_status
         FROM raw_csv r JOIN orders o ON r.nct_number = concat('NCT', lpad(o.o_orderkey::VARCHAR, 8, '0')))
       SELECT 'enrollment: not an integer' AS error, count(*) AS rows_failed FROM checked WHERE bad_number
       UNION ALL SELECT 'nct_id: must start with NCT', count(*) FROM checked WHERE bad_id
       UNION ALL SELECT 'overall_status: not allowed', count(*) FROM checked WHERE bad_status
       UNION ALL SELECT '(valid)', count(*) FROM checked WHERE NOT bad_number AND NOT bad_id AND NOT bad_status""",
    "raw_csv",
)
def validate_csv(t: Tables):
    number = F.substring("nct_number", 4, 8).cast("bigint")
    raw = t.raw_csv.select(
        F.when(number % 13 == 0, F.concat(F.lit("X"), "nct_number")).otherwise(F.lower("nct_number")).alias("nct_id"),
        F.when(number % 17 == 0, F.lit("PAUSED")).otherwise(F.concat(F.lit(" "), "study_status")).alias("overall_status"),
        F.col("study_results").alias("has_results"), "enrollment", "start_date",
    )
    valid, quarantined = validate.validate_csv(raw)
    counts = valid.agg(F.count("*").alias("rows_failed")).select(F.lit("(valid)").alias("error"), "rows_failed")
    return validate.error_counts(quarantined).unionByName(counts)


@query(
    "val02_validate_studies",
    """WITH n AS (SELECT substr(nct_id, 4, 8)::BIGINT AS k FROM raw_json)
       SELECT 'record: unreadable' AS error, count(*) AS rows_failed FROM n WHERE k % 19 = 0
       UNION ALL SELECT 'nctId: missing', count(*) FROM n WHERE k % 19 <> 0 AND k % 23 = 0
       UNION ALL SELECT '(valid)', count(*) FROM n WHERE k % 19 <> 0 AND k % 23 <> 0""",
    "raw_json",
)
def validate_studies(t: Tables):
    number = F.substring("nct_id", 4, 8).cast("bigint")
    text = (
        F.when(number % 19 == 0, F.substring("study_json", 2, 40))
        .when(number % 23 == 0, F.replace("study_json", F.lit("nctId"), F.lit("other")))
        .otherwise(F.col("study_json"))
    )
    valid, quarantined = validate.validate_studies(flatten.parse_studies(t.raw_json.withColumn("study_json", text)))
    counts = valid.agg(F.count("*").alias("rows_failed")).select(F.lit("(valid)").alias("error"), "rows_failed")
    return validate.error_counts(quarantined).unionByName(counts)


@query(
    "val03_blanks_to_null",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS priority, o_orderstatus AS status
       FROM orders""",
)
def blanks(t: Tables):
    padded = F.when(F.col("o_orderkey") % 3 == 0, F.lit(" \t ")).otherwise(F.concat(F.lit("\n "), "o_orderpriority", F.lit(" ")))
    df = t.orders.select("o_orderkey", padded.alias("priority"), F.col("o_orderstatus").alias("status"))
    return validate.blanks_to_null(df)


@query(
    "val04_duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicates(t: Tables):
    return validate.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "val05_check_violations",
    """SELECT 'confidence in [0,1]' AS rule, count(*) FILTER (NOT (l_discount * 15 BETWEEN 0 AND 1)) AS violations FROM lineitem
       UNION ALL SELECT 'offsets ordered', count(*) FILTER (NOT (l_quantity >= l_linenumber * 5)) FROM lineitem
       UNION ALL SELECT 'status allowed', count(*) FILTER (NOT (l_returnflag IN ('A', 'N'))) FROM lineitem
       UNION ALL SELECT 'no self edge', count(*) FILTER (NOT (l_partkey <> l_suppkey)) FROM lineitem""",
)
def checks(t: Tables):
    return validate.check_violations(
        t.lineitem,
        {
            "confidence in [0,1]": (F.col("l_discount") * 15).between(0, 1),
            "offsets ordered": F.col("l_quantity") >= F.col("l_linenumber") * 5,
            "status allowed": F.col("l_returnflag").isin("A", "N"),
            "no self edge": F.col("l_partkey") != F.col("l_suppkey"),
        },
    )
