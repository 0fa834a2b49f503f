"""Hand-computed cases and properties, including keys that hold a large share of the rows."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialspark.operators import (
    embed,
    flatten,
    geo,
    graph,
    harmonize,
    lineage,
    quality,
    retrieval,
    scd,
    search,
    textjobs,
    validate,
)
from trialspark.operators.retrieval import HybridQuery


@pytest.fixture(scope="module")
def notes(spark):
    """Random notes of few words, a third without a vector, under two facets of which one is often null."""
    rng = random.Random(11)
    words = "dose visit serum arm pulse cohort relapse".split()
    rows = [
        (
            7 * i + 3,
            " ".join(rng.choice(words) for _ in range(rng.randint(0, 6))) or None,
            rng.choice(["north", "south", None]),
            rng.randint(1, 4),
            None if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(5)],
        )
        for i in range(90)
    ]
    schema = "document_chunk_id long, chunk_text string, ward string, floor int, embedding array<double>"
    return spark.createDataFrame(rows, schema)


def ids(df):
    return [r["document_chunk_id"] for r in df.collect()]


DIRECTION = [0.3, -0.8, 0.1, 0.6, -0.2]


@pytest.mark.parametrize("weights", [(1.0, 3.0), (2.0, 0.0), (0.0, 0.5)])
def test_scores_are_weighted_and_ordered(notes, weights):
    asked = HybridQuery("Serum dose dose", DIRECTION, {}, 500, *weights)
    found = retrieval.hybrid_retrieve(notes, asked).collect()
    text = {r["document_chunk_id"]: (r["chunk_text"] or "").split() for r in notes.collect()}
    for r in found:
        own = text[r["document_chunk_id"]]
        assert r["lexical_score"] == pytest.approx((("serum" in own) + 2 * ("dose" in own)) / 3)
        share = weights[0] / sum(weights)
        assert r["combined_score"] == pytest.approx(share * r["lexical_score"] + (1 - share) * r["semantic_score"])
    order = [
        (-r["combined_score"], -r["semantic_score"], -r["lexical_score"], str(r["document_chunk_id"])) for r in found
    ]
    assert order == sorted(order)


def test_facets_only_leave_rows_out(notes):
    score = lambda filters: {
        r["document_chunk_id"]: r["combined_score"]
        for r in retrieval.hybrid_retrieve(notes, HybridQuery("pulse", DIRECTION, filters, 500)).collect()
    }
    whole, part = score({}), score({"ward": ["north", None], "floor": 2})
    kept = notes.filter("(ward = 'north' or ward is null) and floor = 2")
    assert set(part) == {r["document_chunk_id"] for r in kept.collect()} < set(whole)
    assert max(part.values()) <= 1  # scores are rated among the rows that are left
    assert score({"nowhere": "x"}) == {} and score({"nowhere": None}) == whole


def test_least_score_and_words_alone(notes):
    found = retrieval.hybrid_retrieve(notes, HybridQuery("relapse cohort", top_k=500, min_combined_score=1.0)).collect()
    both = [r["document_chunk_id"] for r in notes.collect() if {"relapse", "cohort"} <= set((r["chunk_text"] or "").split())]
    assert both and sorted(r["document_chunk_id"] for r in found) == both


def test_ties_are_broken_by_id_as_text(spark):
    rows = [(i, "same", [0.0, 1.0]) for i in (213, 38, 5)]
    df = spark.createDataFrame(rows, "document_chunk_id long, chunk_text string, embedding array<double>")
    asked = HybridQuery("same", [0.0, 1.0], top_k=3)
    found = retrieval.hybrid_retrieve(df, asked).collect()
    assert [r["document_chunk_id"] for r in found] == [213, 38, 5]
    assert {r["combined_score"] for r in found} == {1.0}


@pytest.mark.parametrize("bad", [{"top_k": 0}, {"lexical_weight": -1}, {"query_embedding": []},
                                 {"query_embedding": [1.0], "lexical_weight": 0, "semantic_weight": 0}])
def test_bad_queries(bad):
    with pytest.raises(ValueError):
        HybridQuery("x", **bad)


CSV = "`NCT Number` string, `Study Title` string, `Conditions` string, `Study Results` string, `Enrollment` string"


def test_harmonize_rules(spark):
    csv = spark.createDataFrame([("NCT1", "T1", "a|b", "YES", "5"), ("NCT2", "T2", "c", "NO", "x"), (None, "T0", None, None, None)], CSV)
    studies = [
        ("NCT1", '{"protocolSection":{"identificationModule":{"nctId":"NCT1"},"conditionsModule":{"conditions":[]},'
                 '"eligibilityModule":{"maximumAge":"9 Years"}}}'),
        ("NCT3", '{"protocolSection":{"identificationModule":{"nctId":"NCT3","officialTitle":"O3"}},"hasResults":true}'),
        (None, '{"hasResults":true}'),
    ]
    flat = flatten.flatten_studies(flatten.parse_studies(spark.createDataFrame(studies, "nct_id string, study_json string")))
    rows = {(r["nct_id"], r["title"]): r for r in harmonize.harmonize(csv, flat).collect()}
    assert len(rows) == 5  # rows without an id match nothing
    one = rows["NCT1", "T1"]
    assert one["conditions"] == [] and one["has_results"] is False and one["maximum_age"] is None
    assert one["data_source"] == "csv_only" and one["official_title"] == "T1"
    assert rows["NCT2", "T2"]["has_results"] is None and rows["NCT2", "T2"]["enrollment"] is None
    assert rows["NCT3", None]["data_source"] == "json_priority"
    kept = harmonize.harmonize(csv, flat, empty_as_null=True, results_from_csv=True, fill_unmapped=True)
    rows = {r["nct_id"]: r for r in kept.collect()}
    assert rows["NCT1"]["conditions"] == ["a", "b"] and rows["NCT1"]["maximum_age"] == "9 Years"
    assert rows["NCT2"]["has_results"] is False


def test_validation_splits(spark):
    rows = [("nct1", " RECRUITING ", "5"), ("X1", "PAUSED", "x"), ("  ", None, None)]
    valid, bad = validate.validate_csv(spark.createDataFrame(rows, "nct_id string, overall_status string, enrollment string"))
    assert [r["nct_id"] for r in valid.collect()] == ["NCT1"]
    errors = {r["nct_id"]: r["errors"] for r in bad.collect()}
    assert errors["X1"] == ["nct_id: must start with NCT", "overall_status: not allowed", "enrollment: not an integer"]
    assert errors[None] == ["nct_id: missing"]


def brute_catchment(rows, radius):
    def km(a, b):
        p, q = math.radians(a[2]), math.radians(b[2])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(min(h, 1)))

    out = {}
    for a in rows:
        near = [b for b in rows if b[0] != a[0] and None not in (a[2], b[2]) and km(a, b) <= radius]
        out[a[0]] = (len(near), len({b[1] for b in near}))
    return out


def test_catchment_equals_brute_force_with_a_hot_city(spark):
    rng = random.Random(5)
    hot = [(i, rng.randrange(40), 48.85, 2.35) for i in range(150)]  # a third of all sites, one geocode
    near = [(200 + i, rng.randrange(40), 48.85 + rng.uniform(-1, 1), 2.35 + rng.uniform(-1, 1)) for i in range(150)]
    edge = [(400 + i, rng.randrange(40), rng.choice([89.9, -89.9, 0.1]), rng.choice([-179.95, 179.95, 0.0])) for i in range(100)]
    lost = [(600, 1, None, None), (601, 1, 48.0, None)]
    rows = hot + near + edge + lost
    sites = spark.createDataFrame(rows, "site_id long, trial_id long, latitude double, longitude double")
    trials = spark.createDataFrame([(i, f"NCT{i}") for i in range(40)], "trial_id long, nct_id string")
    got = {r["site_id"]: (r["nearby_site_count"], r["nearby_trial_count"]) for r in geo.site_catchment(sites, trials, 50.0).collect()}
    clean = [r if r[3] is not None else (r[0], r[1], None, None) for r in rows]
    assert got == brute_catchment(clean, 50.0)


def test_catchment_of_ten_thousand_points_in_one_cell(spark):
    rng = np.random.default_rng(4)
    n = 10_000
    lat, lon = 48.85 + rng.uniform(-0.2, 0.2, n), 2.35 + rng.uniform(-0.3, 0.3, n)
    far = 600
    lat[:far], lon[:far] = 48.85 + rng.uniform(-1.2, 1.2, far), 2.35 + rng.uniform(-1.8, 1.8, far)
    trial = rng.integers(0, 300, n)
    rows = list(zip(range(n), trial.tolist(), lat.tolist(), lon.tolist()))
    sites = spark.createDataFrame(rows, "site_id long, trial_id long, latitude double, longitude double")
    trials = spark.createDataFrame([(i, f"NCT{i}") for i in range(300)], "trial_id long, nct_id string")
    got = {r["site_id"]: (r["nearby_site_count"], r["nearby_trial_count"]) for r in geo.site_catchment(sites, trials, 50.0).collect()}
    assert len(got) == n
    p, q = np.radians(lat), np.radians(lon)
    for i in [*range(0, far, 3), *range(far, n, 40)]:
        h = np.sin((p - p[i]) / 2) ** 2 + np.cos(p[i]) * np.cos(p) * np.sin((q - q[i]) / 2) ** 2
        near = 2 * 6371.0088 * np.arcsin(np.sqrt(np.minimum(h, 1))) <= 50.0
        near[i] = False
        assert got[i] == (near.sum(), len(set(trial[near].tolist())))


def test_catchment_moves_points_and_not_their_pairs(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, i % 190 or None, 48.0 + rng.uniform(-0.6, 0.6), 2.0 + rng.uniform(-0.8, 0.8)) for i in range(400)]
    rows += [(400 + i, 7, rows[i][2], rows[i][3]) for i in range(0, 40, 3)]
    sites = spark.createDataFrame(rows, "site_id long, trial_id long, latitude double, longitude double")
    trials = spark.createDataFrame([(i, f"NCT{i}") for i in range(1, 190)], "trial_id long, nct_id string")
    written, cut = [], geo.cut_lineage
    monkeypatch.setattr(geo, "cut_lineage", lambda df: written.append((out := cut(df)).count()) or out)
    expected = {site: near for site, (near, _) in brute_catchment(rows, 50.0).items()}
    without_key = {r[0] for r in rows if r[1] is None}
    whole = {r["site_id"]: (r["nearby_site_count"], r["nearby_trial_count"]) for r in geo.site_catchment(sites, trials, 50.0).collect()}
    assert sum(written) <= len(rows)
    assert {k: v[0] for k, v in whole.items()} == {k: v for k, v in expected.items() if k not in without_key}
    keyed = sites.filter("trial_id is not null")
    truth = brute_catchment([r for r in rows if r[1] is not None], 50.0)
    for most in (30, 10_000):  # parts of a tile, and whole tiles
        got = {r["site_id"]: (r["nearby_site_count"], r["nearby_trial_count"]) for r in geo.site_catchment(keyed, trials, 50.0, most).collect()}
        assert got == truth


def test_radius_search_across_the_date_line_and_pole(spark):
    rows = [(1, 1, 0.0, 179.9), (2, 1, 0.0, -179.9), (3, 1, 89.9, 10.0), (4, 1, 89.9, -170.0), (5, 1, 0.0, 170.0)]
    sites = spark.createDataFrame(rows, "site_id long, trial_id long, latitude double, longitude double")
    trials = spark.createDataFrame([(1, "NCT1")], "trial_id long, nct_id string")
    at = lambda lat, lon: {r["site_id"] for r in geo.sites_within_radius(sites, trials, lat, lon, 50.0).collect()}
    assert at(0.0, 180.0) == {1, 2}
    assert at(90.0, 0.0) == {3, 4}
    assert geo.sites_within_radius(sites, trials, 0.0, 180.0, 50.0, max_results=0).count() == 1


def hot_updates(spark):
    start = datetime.datetime(2024, 1, 1)
    rng = random.Random(3)
    rows = []
    for i in range(900):
        key = 0 if i % 3 == 0 else rng.randrange(1, 30)
        at = start + datetime.timedelta(hours=rng.randrange(24 * 60))  # equal times occur
        rows.append((i, key, at, rng.choice("ab"), rng.choice([1.0, 2.0, None])))
    return spark.createDataFrame(rows, "event_id long, trial_id long, at timestamp_ntz, op string, value double")


@pytest.mark.parametrize("pieces", [1, 8, 300])
def test_versions_do_not_depend_on_the_pieces(spark, pieces):
    df = hot_updates(spark)
    got = scd.build_scd2(df, "trial_id", "at", ["op", "value"], "event_id", pieces)
    w = Window.partitionBy("trial_id").orderBy("at", "event_id")
    plain = df.select("event_id", F.row_number().over(w).alias("n"), F.lead("at").over(w).alias("to"), F.lag("op").over(w).alias("before"))
    joined = got.join(plain, "event_id").collect()
    assert len(joined) == 900
    for r in joined:
        assert r["version_number"] == r["n"] and r["valid_to"] == r["to"] and r["is_current"] == (r["to"] is None)
        changed = r["n"] > 1 and r["before"] != r["op"]
        assert ("op" in r["changed_fields"]) == changed


@pytest.mark.parametrize("pieces", [1, 300])
def test_as_of_equals_range_join(spark, pieces):
    versions = scd.build_scd2(hot_updates(spark), "trial_id", "at", ["op"], "event_id").select("trial_id", "version_number", "valid_from", "valid_to")
    asked = hot_updates(spark).select(F.col("event_id").alias("lookup"), "trial_id", (F.col("at") + F.expr("interval 90 minutes")).alias("asked"))
    got = {(r["lookup"], r["version_number"]) for r in scd.as_of(versions, asked, "trial_id", "asked", "lookup", pieces).collect()}
    inside = (F.col("asked") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("asked") < F.col("valid_to")))
    want = {(r["lookup"], r["version_number"]) for r in asked.join(versions, "trial_id").filter(inside).collect()}
    assert got == want and len(got) == 900


def test_as_of_with_text_ids(spark):
    day = "timestamp_ntz'2024-01-0{}'"
    versions = spark.sql(f"SELECT 1 AS k, 'a' AS v, {day.format(1)} AS valid_from, {day.format(3)} AS valid_to")
    asked = spark.sql(f"SELECT 1 AS k, 'first' AS ask, {day.format(2)} AS at UNION ALL SELECT 1, 'late', {day.format(4)}")
    assert [(r["ask"], r["v"]) for r in scd.as_of(versions, asked, "k", "at", "ask").collect()] == [("first", "a")]


def test_first_request_wins(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("l", 5, None)], "idempotency_key string, requested_at int, body string")
    assert {tuple(r) for r in scd.first_request(df).collect()} == {("k", 1, "a"), ("l", 5, None)}


def test_fingerprint_ignores_order_and_partitions(spark):
    df = spark.range(1000).withColumn("v", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") * 2))
    first = lineage.fingerprint(df).first()
    assert lineage.fingerprint(df.orderBy(F.desc("id")).repartition(13)).first() == first
    assert lineage.fingerprint(df.filter("id != 5")).first() != first
    assert lineage.fingerprint(df.unionByName(df.filter("id = 5")).unionByName(df.filter("id = 5"))).first() != first


def test_promotion_gate(spark):
    asked = spark.createDataFrame([(1,), (2,), (3,), (4,)], "dataset_version_id long")
    checks = spark.createDataFrame(
        [(1, "a", "passed"), (1, "b", "failed"), (2, "a", "failed"), (4, "a", "passed")],
        "dataset_version_id long, check_suite string, gate_status string",
    )
    accepted, blocked = lineage.promote(asked, checks)
    assert {r[0] for r in accepted.collect()} == {1, 4}
    assert {r["dataset_version_id"]: r["reason"] for r in blocked.collect()} == {2: "quality gate failed", 3: "no quality check"}
    assert {r[0] for r in lineage.promote(asked, checks, require_all=True)[0].collect()} == {4}
    with pytest.raises(ValueError):
        lineage.require_promotable(blocked)


def test_closure_ends_on_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 3), (3, 4), (9, 8)], "parent long, child long")
    start = spark.createDataFrame([(1,)], "node long")
    down = {tuple(r) for r in lineage.lineage_closure(edges, start).collect()}
    assert down == {(1, 0), (2, 1), (3, 2), (4, 3)}
    up = {tuple(r) for r in lineage.lineage_closure(edges, spark.createDataFrame([(4,)], "node long"), "up").collect()}
    assert up == {(4, 0), (3, 1), (2, 2), (1, 3)}


def test_k_hop_paths(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e")], "src string, dst string")
    got = {r["node"]: (r["hops"], r["path"]) for r in graph.k_hop(edges, "a", 2).collect()}
    assert got == {"a": (0, ["a"]), "b": (1, ["a", "b"]), "c": (1, ["a", "c"]), "d": (2, ["a", "b", "d"])}


def test_projection_fails_closed(spark):
    empty = lambda schema: spark.createDataFrame([], schema)
    tables = {name: empty("trial_id long") for name in ("arm", "intervention", "condition", "endpoint", "biomarker", "publication")}
    tables["trial"] = spark.createDataFrame([(1, 7)], "trial_id long, sponsor_id long")
    tables["sponsor"] = spark.createDataFrame([(7,)], "sponsor_id long")
    tables["site"] = spark.createDataFrame([(1,)], "trial_id long")
    graph.require_intact(tables)
    tables["site"] = spark.createDataFrame([(1,), (2,), (2,)], "trial_id long")
    with pytest.raises(ValueError, match=r"site.trial_id -> trial.trial_id \(2\)"):
        graph.require_intact(tables)


@pytest.mark.parametrize("size, overlap", [(7, 0), (7, 2), (10, 8), (5, 4)])
def test_chunks_address_the_text(spark, size, overlap):
    rows = [(1, "Ünïcode 𝒳 text\nwith lines, " * 3), (2, "x"), (3, ""), (4, None)]
    df = spark.createDataFrame(rows, "id long, t string")
    texts = dict(rows)
    cut = textjobs.chunk_documents(df, "id", "t", size, overlap).collect()
    assert {r["id"] for r in cut} == {1, 2}
    for r in cut:
        assert r["char_start"] == r["chunk_index"] * (size - overlap)
        assert texts[r["id"]][r["char_start"] : r["char_end"]] == r["chunk_text"]
    assert max(r["char_end"] for r in cut if r["id"] == 1) == len(texts[1])


def test_chunks_know_their_section_and_are_unique(spark):
    text = "intro\n# One\nfirst\n## Deep\nmore\nNotes:\nsmall\n## Side\nlast\n# Two\nend"
    rows = [("N1", "s1", "sys", "r2", text), ("N1", "s1", "sys", "r1", text), ("N1", "s2", "sys", "r1", text), ("N2", "s1", "sys", "r3", None), ("N3", "s1", "sys", "r4", "")]
    df = spark.createDataFrame(rows, "nct_id string, source_snapshot_id string, source_system string, source_record_id string, text string")
    cut = textjobs.document_chunks(df, 6).collect()
    natural = [(r["source_snapshot_id"], r["source_content_sha256"], r["chunk_index"]) for r in cut]
    assert len(set(natural)) == len(natural) and {r["source_record_id"] for r in cut} == {"r1"}
    def section_of(place):
        stack = []
        at = 0
        for line in text.split("\n"):
            if at > place:
                break
            level = len(line) - len(line.lstrip("#")) if line.startswith("#") else 7 if line.endswith(":") else 0
            if level:
                stack = [s for s in stack if s[0] < level] + [(level, line.strip("# :"))]
            at += len(line) + 1
        return " / ".join(t for _, t in stack)
    assert all(r["section_path"] == section_of(r["char_start"]) for r in cut)
    assert {r["section_path"] for r in cut} >= {"", "One", "One / Deep", "One / Deep / Notes", "One / Side", "Two"}


def test_clauses_and_tree(spark):
    criteria = "Age >= 18 years\nInclusion Criteria:\n * HbA1c < 7.5 %\n\nExclusion criteria\n1. Prior stroke\n"
    df = spark.createDataFrame([(1, criteria)], "id long, t string")
    found = textjobs.eligibility_clauses(df, "id", "t")
    rows = found.select("*", textjobs.normalized_clauses("raw_text").alias("n")).orderBy("line_no").collect()
    assert [(r["criterion_type"], r["raw_text"]) for r in rows] == [
        ("unknown", "Age >= 18 years"), ("inclusion", "HbA1c < 7.5 %"), ("exclusion", "Prior stroke"),
    ]
    assert all(criteria[r["char_start"] : r["char_end"]] == r["raw_text"] for r in rows)
    assert [tuple(n)[:4] for n in rows[0]["n"]] == [("age", ">=", 18.0, "years")]
    assert [tuple(n)[:4] for n in rows[1]["n"]] == [("hba1c", "<", 7.5, "%")] and rows[2]["n"] == []
    tree = textjobs.eligibility_tree(found, "id").first()
    assert (tree["inclusion_clauses"], tree["exclusion_clauses"], tree["unknown_clauses"]) == (1, 1, 1)


@pytest.mark.parametrize(
    ("line", "kind", "rest"),
    [
        ("Key Exclusion Criteria:", "exclusion", []),
        ("Exclusion Criteria (Part A):", "exclusion", []),
        ("  ** EXCLUSION CRITERIA **", "exclusion", []),
        ("Exclusion Criteria for part B: pregnant", "exclusion", ["pregnant"]),
        ("Main exclusion criteria: - stroke", "exclusion", ["stroke"]),
        ("Exclusion Criteria - Part A:", "exclusion", []),
        ("Exclusion criteria include:", "exclusion", []),
        ("Exclusion Criteria, Cohort 2:", "exclusion", []),
        ("Exclusion Criteria, Cohort 2", "exclusion", []),
        ("Healthy volunteer exclusion criteria:", "exclusion", []),
        ("Exclusion:", "exclusion", []),
        ("Criteria for exclusion:", "exclusion", []),
        ("The exclusion criteria are as follows:", "exclusion", []),
        ("- Inclusion criteria:", "inclusion", []),
        ("Inclusion and exclusion criteria:", "unknown", []),
        ("Meets none of the exclusion criteria of the protocol", "unknown", ["Meets none of the exclusion criteria of the protocol"]),
        ("- exclusion of pregnancy: by test", "unknown", ["exclusion of pregnancy: by test"]),
    ],
)
def test_criteria_headers(spark, line, kind, rest):
    df = spark.createDataFrame([(1, f"{line}\nlast")], "id long, t string")
    rows = textjobs.eligibility_clauses(df, "id", "t").orderBy("line_no").collect()
    assert [r["raw_text"] for r in rows] == [*rest, "last"]
    assert {r["criterion_type"] for r in rows} == {kind}


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Age >= 18 years and <= 65 years", [("age", ">=", 18.0, "years"), ("age", "<=", 65.0, "years")]),
        ("BMI >= 20 and BMI <= 30", [("bmi", ">=", 20.0, None), ("bmi", "<=", 30.0, None)]),
        ("1. Dose > 5 mg, or weight ≤ 80.5kg", [("dose", ">", 5.0, "mg"), ("weight", "<=", 80.5, "kg")]),
        ("no comparison", []),
        (None, []),
        ("Platelets >= 100,000 /mm3", [("platelets", ">=", 100000.0, "/mm3")]),
        ("ANC ≥ 1,500/uL", [("anc", ">=", 1500.0, "/ul")]),
        ("HbA1c < 7,5 %", [("hba1c", "<", 7.5, "%")]),
        ("weight > -5 kg", [("weight", ">", -5.0, "kg")]),
        ("18 <= age <= 65", [("age", ">=", 18.0, None), ("age", "<=", 65.0, None)]),
        ("18 years ≤ Age ≤ 65 years", [("age", ">=", 18.0, "years"), ("age", "<=", 65.0, "years")]),
        ("bilirubin <= 1.5 x ULN and ALT < 3 x ULN", [("bilirubin", "<=", 1.5, "x uln"), ("alt", "<", 3.0, "x uln")]),
        ("washout > one month", [("washout", ">", None, None)]),
    ],
)
def test_every_comparison_is_found(spark, text, found):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(textjobs.normalized_clauses("t").alias("n")).first()["n"]
    assert [tuple(n)[:4] for n in got] == found
    assert all(n["raw"] in text for n in got)


def test_words_and_terms_of_any_length_and_script(spark):
    df = spark.createDataFrame([(1, "Vièle éréier, non small cell lung cancer")], "id long, t string")
    assert df.select(textjobs.words("t").alias("w")).first()["w"][:2] == ["vièle", "éréier"]
    terms = [("lung cancer", "C1", "disease"), ("non small cell lung cancer", "C2", "disease"), ("vièle", "C3", "lab")]
    dictionary = spark.createDataFrame(terms, "term string, concept_id string, concept_type string")
    links = textjobs.link_concepts(df, "id", "t", dictionary)
    assert {r["concept_id"] for r in links.collect()} == {"C1", "C2", "C3"}
    assert textjobs.first_entities(links, "id").first()["entity_count"] == 3
    first = links.filter("concept_id = 'C3'").first()
    assert (first["concept_label"], first["normalized_value"], first["confidence"]) == ("vièle", "vièle", 1.0)


def test_rows_into_the_term_join_follow_matches(spark):
    long_term = " ".join(f"w{i}" for i in range(12))
    terms = [(long_term, "C1", "disease"), ("w0 w1", "C2", "lab"), ("rare", "C3", "treatment")]
    dictionary = spark.createDataFrame(terms, "term string, concept_id string, concept_type string")
    texts = [(i, "filler " * 500 + ("w0 w1 w3 " if i % 2 else long_term) + " filler" * 500) for i in range(20)]
    df = spark.createDataFrame(texts, "id long, t string")
    entering = textjobs.dictionary_words(df, "id", "t", textjobs.term_trie(dictionary)).count()
    assert entering == 10 * 3 + 10 * 12  # of 20 * 1,000 words and 12 times as many n-grams
    links = {(r["id"], r["concept_id"], r["char_start"]) for r in textjobs.link_concepts(df, "id", "t", dictionary).collect()}
    assert links == {(i, "C2", 3500) for i in range(20)} | {(i, "C1", 3500) for i in range(0, 20, 2)}


def test_embeddings(spark):
    rows = [("NCT1", "lung cancer", "x" * 600), ("NCT2", None, "  "), ("NCT3", "lung cancer", "x" * 700)]
    df = spark.createDataFrame(rows, "nct_id string, title string, brief_summary string")
    made = {r["nct_id"]: r["embedding"] for r in embed.generate_embeddings(df, summary_limit=500).collect()}
    assert set(made) == {"NCT1", "NCT3"}
    assert made["NCT1"] == made["NCT3"]  # the summary is cut to 500 characters
    assert np.linalg.norm(made["NCT1"]) == pytest.approx(1) and len(made["NCT1"]) == 384
    own = embed.generate_embeddings(df, load=lambda: lambda texts: np.array([[len(t), 1] for t in texts]), batch_size=1)
    assert {r["nct_id"]: r["embedding"] for r in own.collect()}["NCT1"] == [612.0, 1.0]
    stats = embed.embedding_statistics(embed.generate_embeddings(df.filter("nct_id = 'NCT2'"))).first()
    assert stats["total_embeddings"] == 0 and stats["error"] == "No texts to embed"

    def stumbling(texts):
        if any("cancer" in t for t in texts):
            raise RuntimeError("cannot read this")
        return np.ones((len(texts), 3))

    more = df.unionByName(spark.createDataFrame([("NCT4", "asthma", "plain"), ("NCT5", "a", "b")], df.schema)).coalesce(1)
    kept = embed.generate_embeddings(more, load=lambda: stumbling, keep_failures=True)
    assert {r["nct_id"]: (r["embedding"] is None, r["error"]) for r in kept.collect()} == {
        "NCT1": (True, "cannot read this"), "NCT3": (True, "cannot read this"), "NCT4": (False, None), "NCT5": (False, None),
    }
    stats = embed.embedding_statistics(kept).first()
    assert (stats["total_embeddings"], stats["embedding_dimension"], stats["error"]) == (2, 3, "cannot read this")


def test_full_text_of_any_script_from_a_stored_index(spark, tmp_path):
    rows = [(1, "Vièle à roue, naïve"), (2, "VIÈLE seule"), (3, "日本 vièle roue roue"), (4, None)]
    df = spark.createDataFrame(rows, "id long, t string")
    path = retrieval.write_inverted_index(retrieval.build_inverted_index(df, "id", "t", 8), str(tmp_path / "index"))
    index = spark.read.parquet(path)
    found = {r["id"]: r["occurrences"] for r in retrieval.search_index(index, "roue Vièle roue", "id", 8).collect()}
    assert found == {1: 2, 3: 3}
    assert retrieval.search_index(index, " ?! ", "id", 8).count() == 0


def test_fields_outside_the_declared_record(spark):
    from trialspark.sources.studies import load_studies

    texts = [("N1", '{"protocolSection":{"identificationModule":{"nctId":"N1"},"extra":{"a":[1,2],"b":{"c":"x"}}}}'), ("N2", "{}")]
    good, _ = load_studies(spark.createDataFrame(texts, "nct_id string, study_json string"))
    paths = ["protocolSection.identificationModule.nctId", "protocolSection.extra.b.c", "protocolSection.extra.a", "protocolSection.none"]
    got = search.project_fields(good.select("study_json", "study.*"), paths, "study_json").collect()
    assert [tuple(r) for r in got] == [("N1", "x", "[1,2]", None), (None, None, None, None)]


def test_quality_metrics_count_failed_embeddings_as_none(spark):
    some = spark.range(10)
    features = spark.createDataFrame([(10, 0.5), (20, 0.7)], "token_count long, lexical_diversity double")
    made = spark.createDataFrame([(1, [1.0]), (2, None)], "id long, embedding array<float>")
    row = quality.quality_metrics(some, some.limit(8), features, made).first()
    assert (row["total_expected"], row["total_processed"], row["nlp_processed"], row["embeddings_generated"]) == (10, 8, 2, 1)
    judged = quality.quality_gate(quality.quality_metrics(some, some, features.limit(0)), quality.QualityThresholds(min_studies_processed=5)).first()
    assert judged["passed"] and judged["embeddings_generated"] == 0


def test_quality_gate_reports(spark):
    metrics = spark.createDataFrame(
        [(100, 90, 10.0, 0.05), (100, 120, 80.0, 0.5), (0, 0, 80.0, 0.5)],
        "total_expected long, total_processed long, avg_token_count double, avg_lexical_diversity double",
    )
    judged = quality.quality_gate(metrics, quality.QualityThresholds(min_studies_processed=50)).collect()
    assert not judged[0]["passed"]
    assert [(i["metric"], i["limit"]) for i in judged[0]["issues"]] == [
        ("error_rate", 0.05), ("avg_token_count", 50.0), ("avg_lexical_diversity", 0.1),
    ]
    assert judged[0]["issues"][0]["value"] == pytest.approx(0.1)
    assert judged[1]["passed"] and judged[1]["error_rate"] == pytest.approx(-0.2)
    assert not judged[2]["passed"] and judged[2]["error_rate"] == 1


def test_pages_cover_everything_once(spark):
    rows = [(f"NCT{i:02d}", None if i % 4 == 0 else i % 3, datetime.date(2020, 1, 1 + i % 5)) for i in range(23)]
    df = spark.createDataFrame(rows, "nct_id string, size int, updated date")
    for sort in (["updated", "size"], ["size:desc"], ["size", "updated:asc"]):
        seen, after = [], None
        keys = [s.split(":")[0] for s in sort] + ["nct_id"]
        while page := search.page_studies(df, sort, after, 5).collect():
            seen += [r["nct_id"] for r in page]
            after = tuple(page[-1][k] for k in keys)
        assert seen == [r["nct_id"] for r in search.sort_studies(df, sort).collect()]
        assert len(set(seen)) == 23


def test_geo_arguments():
    assert search.parse_geo("distance(39.0,-77.1,50mi)") == (39.0, -77.1, pytest.approx(80.4672))
    with pytest.raises(ValueError):
        search.parse_geo("circle(1,2,3)")
