"""Study search: filters, relevance, projection, sorting, paging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from trialspark.operators import flatten, graph, search
from trialspark.plans.geography import NEAR, CENTER, duck_km
from trialspark.plans.registry import query
from trialspark.plans.tables import Tables
from trialspark.session import run_dir
from trialspark.sources.studies import load_studies


@query(
    "prj14_filter_studies",
    f"""SELECT nct_id, overall_status, enrollment FROM trial WHERE overall_status IN ('RECRUITING', 'TERMINATED')
          AND enrollment BETWEEN 100 AND 400 AND last_update_posted >= DATE '1995-06-01'
          AND trial_id IN (SELECT trial_id FROM site WHERE latitude IS NOT NULL AND {duck_km('latitude', 'longitude', *CENTER)} <= 900)""",
    "trial site",
)
def filtered(t: Tables):
    import datetime

    found = search.filter_studies(
        t.trial, statuses=["RECRUITING", "TERMINATED"], geo=NEAR, sites=t.site,
        ranges={"enrollment": (100, 400), "last_update_posted": (datetime.date(1995, 6, 1), None)},
    )
    return found.select("nct_id", "overall_status", "enrollment")


@query(
    "prj15_area_search",
    """WITH w AS (SELECT publication_id, regexp_extract_all(lower(title), '[a-z0-9]+') AS a, regexp_extract_all(lower(journal), '[a-z0-9]+') AS b FROM publication),
       h AS (SELECT *, list_contains(a, 'red') AS a1, list_contains(a, 'journal') AS a2, list_contains(b, 'red') AS b1, list_contains(b, 'journal') AS b2 FROM w)
       SELECT publication_id, round((a1::INT + a2::INT) / 2 * 1.0 + (b1::INT + b2::INT) / 2 * 0.6, 6) AS relevance FROM h
       WHERE (a1 OR b1) AND (a2 OR b2)""",
    "publication",
)
def area(t: Tables):
    found = search.search_area(t.publication, "Red journal", {"title": 1.0, "journal": 0.6})
    return found.select("publication_id", F.round("relevance", 6).alias("relevance"))


@query(
    "prj16_aggregation_filters",
    """SELECT nct_id, overall_status, phase FROM trial WHERE overall_status IN ('NOT_YET_RECRUITING', 'RECRUITING')
       AND study_type = 'INTERVENTIONAL' AND phase IN ('PHASE_2', 'PHASE_3')""",
    "trial",
)
def aggregation_filters(t: Tables):
    return search.agg_filters(t.trial, "status:not rec,studyType:int,phase:2 3").select("nct_id", "overall_status", "phase")


@query(
    "prj17_list_size_filter",
    """SELECT trial_id, count(*) AS conditions FROM condition GROUP BY 1 HAVING count(*) BETWEEN 3 AND 5""",
    "condition",
)
def list_size(t: Tables):
    lists = t.condition.groupBy("trial_id").agg(F.collect_list("condition_name").alias("conditions"))
    found = search.filter_list_size(lists, "conditions", 3, 5)
    return found.select("trial_id", F.size("conditions").cast("bigint").alias("conditions"))


@query(
    "prj18_project_fields",
    """SELECT json_extract_string(study_json, '$.protocolSection.identificationModule.nctId') AS protocol_nct,
         json_extract_string(study_json, '$.protocolSection.identificationModule.officialTitle') AS official_title,
         json_extract(study_json, '$.protocolSection.designModule.enrollmentInfo.count')::BIGINT AS enrolled FROM raw_json""",
    "raw_json",
)
def projected(t: Tables):
    good, _ = load_studies(t.raw_json)
    base = "protocolSection."
    found = search.project_fields(
        good.select("study.*"),
        [base + "identificationModule", base + "designModule.enrollmentInfo.count"],
    )
    return found.select(
        F.col("protocolSection_identificationModule.nctId").alias("protocol_nct"),
        F.col("protocolSection_identificationModule.officialTitle").alias("official_title"),
        F.col("protocolSection_designModule_enrollmentInfo_count").alias("enrolled"),
    )


@query(
    "prj20_synonym_filter",
    """WITH s AS (SELECT DISTINCT lower(condition_name) AS term, length(condition_name) % 5 AS id FROM condition)
       SELECT nct_id, overall_status FROM trial WHERE trial_id IN (SELECT trial_id FROM condition JOIN s ON lower(condition_name) = term AND id = 2)
       AND trial_id IN (SELECT trial_id FROM intervention WHERE length(intervention_name) % 3 = 1)""",
    "trial condition intervention",
)
def synonyms(t: Tables):
    conditions = t.condition.select("trial_id", F.col("condition_name").alias("term"))
    interventions = t.intervention.select("trial_id", F.col("intervention_name").alias("term"))
    row = lambda df, area, n: df.select(
        F.lit(area).alias("area"), (F.length("term") % n).alias("synonym_id"), F.lower("term").alias("term")
    ).distinct()
    table = row(conditions, "ConditionSearch", 5).unionByName(row(interventions, "InterventionSearch", 3))
    areas = {"ConditionSearch": conditions, "InterventionSearch": interventions}
    pairs = [("ConditionSearch", 2), ("InterventionSearch", 1)]
    return search.filter_synonyms(t.trial, pairs, table, areas, "trial_id").select("nct_id", "overall_status")


_SORTED = """WITH p AS (SELECT nct_id, CASE WHEN trial_id % 9 <> 0 THEN last_update_posted END AS updated, enrollment FROM trial),
  r AS (SELECT *, row_number() OVER (ORDER BY updated DESC NULLS LAST, enrollment ASC NULLS LAST, nct_id) AS r FROM p)
  SELECT nct_id, strftime(updated, '%Y-%m-%d') AS updated, enrollment FROM r """


def _dated(t: Tables):
    updated = F.when(F.col("trial_id") % 9 != 0, F.col("last_update_posted"))
    return t.trial.select("nct_id", updated.alias("updated"), "enrollment")


def _shown(df):
    return df.withColumn("updated", F.col("updated").cast("string"))


@query("sl03_sorted_listing", _SORTED + "WHERE r <= 200", "trial")
def sorted_listing(t: Tables):
    return _shown(search.page_studies(_dated(t), ["updated", "enrollment"], page_size=200))


@query("sl04_second_page", _SORTED + "WHERE r > 200 AND r <= 400", "trial")
def second_page(t: Tables):
    df = _dated(t)
    last = search.page_studies(df, ["updated", "enrollment"], page_size=200).collect()[-1]
    after = (last["updated"], last["enrollment"], last["nct_id"])
    return _shown(search.page_studies(df, ["updated", "enrollment"], after, 200))


@query("sl04_page_among_nulls", _SORTED + "WHERE updated IS NULL QUALIFY row_number() OVER (ORDER BY r) BETWEEN 51 AND 100", "trial")
def page_among_nulls(t: Tables):
    df = _dated(t)
    empty = df.filter(F.col("updated").isNull())
    last = search.page_studies(empty, ["updated", "enrollment"], page_size=50).collect()[-1]
    return _shown(search.page_studies(df, ["updated", "enrollment"], (None, last["enrollment"], last["nct_id"]), 50))


#: Studies of one task where records are built, parsed and loaded.
STUDIES_AT_ONCE = 50_000


def full_studies(t: Tables):
    """A nested record with every module for each order, as JSON text.

    The orders are dealt before the records are made of them: a file of few row groups is read by few tasks.
    """
    k = F.col("o_orderkey")
    text = lambda prefix, n: F.concat(F.lit(prefix), n.cast("string"))
    many = lambda n, make: F.transform(F.sequence(F.lit(1), n), make)  # n is at least 1
    some = lambda n, make: F.when(n > 0, many(F.greatest(n, F.lit(1)), make))
    dated = lambda d: F.struct(d.cast("date").cast("string").alias("date"))
    day = F.col("o_orderdate").cast("date")
    outcome = lambda kind: lambda i: F.struct(text(f"{kind} ", k % 9 + i).alias("measure"), text("week ", i).alias("timeFrame"))
    protocol = F.struct(
        F.struct(
            nct_of(k).alias("nctId"), text("Brief ", k).alias("briefTitle"), F.when(k % 6 != 0, text("Official ", k)).alias("officialTitle"),
            text("A", k % 5).alias("acronym"),
        ).alias("identificationModule"),
        F.struct(
            F.col("o_orderstatus").alias("overallStatus"), dated(day).alias("startDateStruct"), dated(F.date_add(day, 30)).alias("completionDateStruct"),
            dated(day).alias("studyFirstPostDateStruct"), dated(F.date_add(day, (k % 400).cast("int"))).alias("lastUpdatePostDateStruct"),
        ).alias("statusModule"),
        F.struct(F.struct(text("Sponsor ", F.col("o_custkey")).alias("name"), F.lit("INDUSTRY").alias("class")).alias("leadSponsor")).alias("sponsorCollaboratorsModule"),
        F.struct(text("Summary ", k).alias("briefSummary"), F.when(k % 4 != 0, text("Details ", k)).alias("detailedDescription")).alias("descriptionModule"),
        F.struct(some(k % 3, lambda i: text("Condition ", k % 11 + i)).alias("conditions")).alias("conditionsModule"),
        F.struct(
            F.lit("INTERVENTIONAL").alias("studyType"), F.array(text("PHASE", 1 + k % 4)).alias("phases"),
            F.struct(F.col("o_custkey").alias("count")).alias("enrollmentInfo"),
        ).alias("designModule"),
        F.struct(
            many(k % 3 + 1, lambda i: F.struct(text("Arm ", i).alias("label"), F.lit("EXPERIMENTAL").alias("type"))).alias("armGroups"),
            many(k % 2 + 1, lambda i: F.struct(F.lit("DRUG").alias("type"), text("Drug ", k % 13 + i).alias("name"))).alias("interventions"),
        ).alias("armsInterventionsModule"),
        F.struct(many(F.lit(1), outcome("Primary")).alias("primaryOutcomes"), some(k % 3, outcome("Secondary")).alias("secondaryOutcomes")).alias("outcomesModule"),
        F.struct(
            F.lit("ALL").alias("sex"), text("", 18 + k % 3).alias("minimumAge"), text("", 60 + k % 7).alias("maximumAge"), (k % 2 == 0).alias("healthyVolunteers")
        ).alias("eligibilityModule"),
        F.struct(
            some(k % 4, lambda i: F.struct(
                text("Site ", i).alias("facility"), text("City ", k % 17).alias("city"), F.lit("Wales").alias("country"),
                F.struct((k % 90).cast("double").alias("lat"), i.cast("double").alias("lon")).alias("geoPoint"),
            )).alias("locations")
        ).alias("contactsLocationsModule"),
        F.struct(some(k % 2, lambda i: F.struct(text("", k + i).alias("pmid"), text("Paper ", k).alias("citation"))).alias("references")).alias("referencesModule"),
        # parts that no flattened column reads
        F.struct(F.struct(F.lit("kept").alias("note")).alias("ancestors")).alias("interventionBrowseModule"),
    )
    study = F.struct(
        protocol.alias("protocolSection"),
        F.struct(F.struct(F.array(F.struct(text("Mesh ", k % 8).alias("term"))).alias("meshes")).alias("conditionBrowseModule")).alias("derivedSection"),
        F.struct(F.struct(some(k % 2, lambda i: F.struct(text("doc", k).alias("filename"))).alias("largeDocs")).alias("largeDocumentModule")).alias("documentSection"),
        (k % 2 == 0).alias("hasResults"),
    )
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    dealt = orders.repartition(-(-orders.count() // STUDIES_AT_ONCE) or 1)
    return dealt.select(nct_of(k).alias("nct_id"), F.to_json(study).alias("study_json"))


def nct_of(k):
    return F.concat(F.lit("NCT"), F.lpad(k.cast("string"), 8, "0"))


_FULL = """WITH o AS (SELECT o_orderkey AS k, concat('NCT', lpad(o_orderkey::VARCHAR, 8, '0')) AS id, o_custkey AS c, o_orderstatus AS status,
  o_orderdate::DATE AS day FROM orders)
"""


@query(
    "prj05_flatten_every_column",
    _FULL
    + """SELECT id AS json_nct_id, CASE WHEN k % 6 <> 0 THEN concat('Official ', k) END AS json_official_title, concat('Brief ', k) AS json_brief_title,
      concat('A', k % 5) AS json_acronym, status AS json_overall_status, 'INTERVENTIONAL' AS json_study_type, concat('PHASE_', 1 + k % 4) AS json_phases,
      k % 2 = 0 AS json_has_results, concat('Summary ', k) AS json_brief_summary, CASE WHEN k % 4 <> 0 THEN concat('Details ', k) END AS json_detailed_description,
      array_to_string(list_transform(range(1, k % 3 + 1), lambda i: concat('Condition ', k % 11 + i)), '|') AS json_conditions,
      array_to_string(list_transform(range(1, k % 2 + 2), lambda i: concat('Drug ', k % 13 + i)), '|') AS json_interventions,
      concat('Mesh ', k % 8) AS json_condition_meshes, 'ALL' AS json_sex, (18 + k % 3)::VARCHAR AS json_minimum_age, (60 + k % 7)::VARCHAR AS json_maximum_age,
      k % 2 = 0 AS json_healthy_volunteers, c AS json_enrollment, strftime(day, '%Y-%m-%d') AS json_start_date,
      strftime(day + 30, '%Y-%m-%d') AS json_completion_date, CASE WHEN k % 2 = 1 THEN concat('doc', k) ELSE '' END AS json_document_files FROM o""",
)
def flatten_full(t: Tables):
    """All 21 columns of records with every module; lists joined by bars."""
    flat = flatten.flatten_studies(flatten.parse_studies(full_studies(t)))
    return flat.select(*[F.array_join(n, "|").alias(n) if kind.startswith("array") else F.col(n) for n, kind in flat.dtypes])


@query(
    "ln09_canonical_load",
    _FULL
    + """, rows AS (
       SELECT id, 'trial' AS table_name, concat_ws('/', CASE WHEN k % 6 <> 0 THEN concat('Official ', k) END, concat('Brief ', k), status, concat('PHASE_', 1 + k % 4),
         c, strftime(day, '%Y-%m-%d'), strftime(day + (k % 400)::INT, '%Y-%m-%d')) AS content FROM o
       UNION ALL SELECT min(id), 'sponsor', concat('Sponsor ', c, '/INDUSTRY') FROM o GROUP BY c
       UNION ALL SELECT id, 'condition', concat('Condition ', k % 11 + i) FROM o, unnest(range(1, k % 3 + 1)) x(i)
       UNION ALL SELECT id, 'intervention', concat('DRUG/Drug ', k % 13 + i) FROM o, unnest(range(1, k % 2 + 2)) x(i)
       UNION ALL SELECT id, 'arm', concat('Arm ', i, '/EXPERIMENTAL') FROM o, unnest(range(1, k % 3 + 2)) x(i)
       UNION ALL SELECT id, 'endpoint', concat('primary/Primary ', k % 9 + 1, '/week 1') FROM o
       UNION ALL SELECT id, 'endpoint', concat('secondary/Secondary ', k % 9 + i, '/week ', i) FROM o, unnest(range(1, k % 3 + 1)) x(i)
       UNION ALL SELECT id, 'site', concat('Site ', i, '/City ', k % 17, '/Wales/', k % 90, '/', i) FROM o, unnest(range(1, k % 4 + 1)) x(i)
       UNION ALL SELECT id, 'publication', concat(k + i, '/Paper ', k) FROM o, unnest(range(1, k % 2 + 1)) x(i))
     SELECT table_name, id AS source_record_id, content, 'snapshot-1' AS source_snapshot_id FROM rows""",
)
def canonical(t: Tables):
    """Every row of the eight tables as text, read back after one pass over the records."""
    good, _ = load_studies(full_studies(t))
    tables = flatten.write_canonical(good, run_dir(t.spark, "canonical"), "snapshot-1")
    whole = lambda c: F.col(c).cast("bigint").cast("string")
    shown = {
        "trial": ["official_title", "brief_title", "overall_status", "phase", whole("enrollment"), F.col("first_posted").cast("string"), F.col("last_update_posted").cast("string")],
        "sponsor": ["sponsor_name", "sponsor_type"], "condition": ["condition_name"], "intervention": ["intervention_type", "intervention_name"],
        "arm": ["arm_label", "arm_type"], "endpoint": ["endpoint_type", "endpoint_name", "endpoint_timeframe"],
        "site": ["facility_name", "city", "country", whole("latitude"), whole("longitude")], "publication": ["pmid", "title"],
    }
    rows = [
        tables[name].select(F.lit(name).alias("table_name"), "source_record_id", F.concat_ws("/", *columns).alias("content"), "source_snapshot_id")
        for name, columns in shown.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


@query(
    "prj18_fields_outside_the_schema",
    _FULL
    + """SELECT id AS nct_id, concat('Brief ', k) AS brief_title, 'kept' AS note, '{"note":"kept"}' AS ancestors,
       CASE WHEN k % 3 > 0 THEN concat('Condition ', k % 11 + 1) END AS first_condition, NULL::VARCHAR AS absent FROM o""",
)
def undeclared(t: Tables):
    """Fields that no declared type has, beside declared ones."""
    good, _ = load_studies(full_studies(t))
    base = "protocolSection."
    paths = ["identificationModule.briefTitle", "interventionBrowseModule.ancestors.note", "interventionBrowseModule.ancestors", "conditionsModule.conditions[0]", "miscInfoModule.versionHolder"]
    rows = good.select("nct_id", "study_json", "study.*")
    found = search.project_fields(rows, ["nct_id", *[base + p for p in paths]], "study_json")
    return found.toDF("nct_id", "brief_title", "note", "ancestors", "first_condition", "absent")


@query(
    "gr05_canonical_k_hop",
    _FULL
    + """, n AS (SELECT k, c, unnest([{'r': 'Arm', 'n': k % 3 + 1}, {'r': 'Intervention', 'n': k % 2 + 1}, {'r': 'Condition', 'n': k % 3},
         {'r': 'Endpoint', 'n': k % 3 + 1}, {'r': 'Site', 'n': k % 4}, {'r': 'Publication', 'n': k % 2}]) AS x FROM o WHERE c = (SELECT min(c) FROM o))
       SELECT 'Sponsor' AS label, 0::BIGINT AS hops, 1::BIGINT AS nodes UNION ALL SELECT 'Trial', 1, count(*) FROM o WHERE c = (SELECT min(c) FROM o)
       UNION ALL SELECT x.r, 2, sum(x.n)::BIGINT FROM n GROUP BY 1 HAVING sum(x.n) > 0""",
)
def canonical_hops(t: Tables):
    """What a sponsor's trials lead to, over the graph of the loaded tables and their own ids."""
    good, _ = load_studies(full_studies(t))
    tables = flatten.write_canonical(good, run_dir(t.spark, "canonical"), "snapshot-1")
    tables["biomarker"] = tables["condition"].limit(0).select("trial_id", F.col("condition_name").alias("biomarker_name"))
    first = t.orders.agg(F.min("o_custkey")).first()[0]
    start = tables["sponsor"].filter(F.col("sponsor_name") == f"Sponsor {first}").first()["sponsor_id"]
    found = graph.k_hop(graph.graph_edges(tables, "snapshot-1"), f"Sponsor:{start}", 2, stored=True)
    return found.groupBy(F.substring_index("node", ":", 1).alias("label"), F.col("hops").cast("bigint").alias("hops")).agg(F.count("*").alias("nodes"))


@query(
    "ln09_canonical_trials",
    """SELECT nct_id, json_extract_string(study_json, '$.protocolSection.identificationModule.officialTitle') AS official_title,
         concat('PHASE_', json_extract_string(study_json, '$.protocolSection.designModule.phases[0]')[6:6]) AS phase,
         json_extract(study_json, '$.protocolSection.designModule.enrollmentInfo.count')::BIGINT AS enrollment,
         sha256(study_json) AS source_content_sha256, nct_id AS source_record_id FROM raw_json""",
    "raw_json",
)
def canonical_trials(t: Tables):
    good, _ = load_studies(t.raw_json)
    trials = flatten.load_canonical(good, "snapshot-1")["trial"]
    return trials.select(
        "nct_id", "official_title", "phase", F.col("enrollment").cast("bigint").alias("enrollment"),
        "source_content_sha256", "source_record_id",
    )
