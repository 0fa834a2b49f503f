"""The canonical load in one pass, its graph, and parity of a written projection."""

import datetime
import json

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from trialspark.operators import flatten, graph
from trialspark.plans import graphs, searching
from trialspark.plans.tables import Tables

AT = datetime.datetime(2024, 5, 1)


def study(n, **modules):
    return json.dumps({"protocolSection": {"identificationModule": {"nctId": f"NCT{n}"}} | modules})


@pytest.fixture
def studies(spark):
    rows = [
        ("NCT1", study(1, sponsorCollaboratorsModule={"leadSponsor": {"name": "Acme", "class": "INDUSTRY"}},
                       conditionsModule={"conditions": ["asthma", None, "copd"]},
                       armsInterventionsModule={"armGroups": [{"label": "A"}, {"type": "OTHER"}], "interventions": [{"name": "x", "type": "DRUG"}]},
                       contactsLocationsModule={"locations": [{}, {"facility": "F", "geoPoint": {"lat": 1.5, "lon": 2}}]})),
        ("NCT2", study(2, sponsorCollaboratorsModule={"leadSponsor": {"name": "Acme", "class": "OTHER"}}, outcomesModule={"otherOutcomes": [{"measure": "m"}]},
                       referencesModule={"references": [{"pmid": "7", "citation": "c"}]})),
        ("NCT3", study(3)),
    ]
    return flatten.parse_studies(spark.createDataFrame(rows, "nct_id string, study_json string"))


def test_one_pass_equals_a_plan_for_each_table(studies, tmp_path):
    each = flatten.load_canonical(studies, "s1")
    once = flatten.write_canonical(studies, str(tmp_path / "canonical"), "s1")
    assert each.keys() == once.keys()
    for name in each:
        assert each[name].columns == once[name].columns
        assert sorted(map(repr, each[name].collect())) == sorted(map(repr, once[name].collect()))
    counts = {name: df.count() for name, df in once.items()}
    assert counts == {"trial": 3, "sponsor": 1, "condition": 2, "intervention": 1, "arm": 1, "endpoint": 1, "site": 2, "publication": 1}
    assert once["sponsor"].first()["sponsor_type"] == "INDUSTRY"
    plan = once["trial"]._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan.lower()


def test_parity_finds_planted_breaks_by_key(studies, tmp_path, spark):
    tables = flatten.write_canonical(studies, str(tmp_path / "canonical"), "s1")
    tables["biomarker"] = spark.createDataFrame([], "biomarker_id long, trial_id long, biomarker_name string")
    nodes, edges = graph.project(tables, "s1", str(tmp_path / "graph"), AT)
    assert {r["projected_at"] for r in nodes.select("projected_at").distinct().collect()} == {AT}
    ids = {r["node_id"] for r in nodes.filter("label = 'Condition'").collect()}
    assert ids == {f"Condition:{r['condition_id']}" for r in tables["condition"].collect()}
    assert graph.parity_breaks(nodes, edges, tables, "s1", buckets=4).count() == 0
    assert graph.projection_parity(nodes, edges, tables).filter("diff <> 0").count() == 0
    lost = tables["site"].orderBy("site_id").first()["site_id"]
    broken = nodes.filter(F.col("node_id") != f"Site:{lost}").withColumn(
        "name", F.when(F.col("label") == "Sponsor", "Other").otherwise(F.col("name"))
    )
    extra = edges.filter("relationship = 'MEASURES'")
    found = {(r["kind"], r["problem"]) for r in graph.parity_breaks(broken, edges.unionByName(extra), tables, "s1", buckets=4).collect()}
    assert found == {("Site", "missing"), ("Sponsor", "different"), ("MEASURES", "extra")}


def test_projection_fails_closed(studies, tmp_path, spark):
    tables = flatten.load_canonical(studies, "s1")
    tables["biomarker"] = spark.createDataFrame([(1, 5, "b")], "biomarker_id long, trial_id long, biomarker_name string")
    with pytest.raises(ValueError, match="biomarker"):
        graph.project(tables, "s1", str(tmp_path / "graph"), AT)
    assert not (tmp_path / "graph").exists()


def test_load_moves_no_row(studies, tmp_path, monkeypatch):
    written, write = [], DataFrameWriter.parquet

    def seen(self, path, *rest, **named):
        written.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, path, *rest, **named)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    found = flatten.write_canonical(studies.repartition(2), str(tmp_path / "canonical"), "s1")
    assert len(written) == 1 and "Rebalance" not in written[0]
    assert found["arm"].count() == 1 and found["site"].count() == 2


def test_orders_are_dealt_before_records_are_made(spark, tmp_path, monkeypatch):
    rows = "select id o_orderkey, 7L o_custkey, 'F' o_orderstatus, timestamp'1996-02-03' o_orderdate from range(1, 6, 1, 1)"
    spark.sql(rows).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(searching, "STUDIES_AT_ONCE", 2, raising=False)
    made = searching.full_studies(Tables(spark, str(tmp_path)))
    assert made.rdd.getNumPartitions() == 3
    assert sorted(r["nct_id"] for r in made.collect()) == [f"NCT{n:08d}" for n in range(1, 6)]
    spark.sql(rows).limit(0).write.parquet(f"{tmp_path}/none/orders.parquet")
    assert searching.full_studies(Tables(spark, f"{tmp_path}/none")).count() == 0


def test_stored_edges_are_not_written_again(spark, monkeypatch):
    edges = spark.createDataFrame([("a", "b"), ("b", "b"), ("c", "b"), ("c", None), ("d", "e")], "src string, dst string")
    kept, cut = [], graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: kept.append(df.columns) or cut(df))
    for directed, reach in ((False, {"a": 0, "b": 1, "c": 2}), (True, {"a": 0, "b": 1})):
        each = graph.k_hop(edges, "a", 2, directed)
        once = len(kept)
        again = graph.k_hop(edges, "a", 2, directed, stored=True)
        assert ["src", "dst"] in kept[:once] and ["src", "dst"] not in kept[once:]
        assert sorted(map(tuple, each.collect())) == sorted(map(tuple, again.collect()))
        assert {r["node"]: r["hops"] for r in again.collect()} == reach
        kept.clear()


def test_projection_is_written_from_tables_built_once(spark, tmp_path, monkeypatch):
    base = {
        "customer": "1L c_custkey, 'Acme' c_name, 'INDUSTRY' c_mktsegment",
        "orders": "2L o_orderkey, 1L o_custkey, 'F' o_orderstatus, 10D o_totalprice, timestamp'1996-02-03' o_orderdate",
        "part": "3L p_partkey, 'red rod' p_name, 'Brand#1' p_brand, 'ECON' p_type, 4 p_size",
        "supplier": "5L s_suppkey, 'S' s_name, 6 s_nationkey", "nation": "6 n_nationkey, 'N' n_name, 7 n_regionkey", "region": "7 r_regionkey, 'R' r_name",
        "lineitem": "2L l_orderkey, explode(array(1, 1, 2)) l_linenumber, 3L l_partkey, 5L l_suppkey, 'A' l_returnflag, 'F' l_linestatus, timestamp'1997-02-03' l_shipdate",
    }
    for name, columns in base.items():
        spark.sql(f"select {columns}").write.parquet(f"{tmp_path}/{name}.parquet")
    written, write = {}, DataFrameWriter.parquet

    def seen(self, path, *rest, **named):
        written[path] = self._df._jdf.queryExecution().executedPlan().toString()
        return write(self, path, *rest, **named)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    found = {r["kind"]: r["projected"] for r in graphs.parity(Tables(spark, str(tmp_path))).filter("diff = 0").collect()}
    assert len(found) == 17 and found["Arm"] == found["HAS_ARM"] == 2 and found["Site"] == 1
    projected = {path: plan for path, plan in written.items() if "projection-" in path}
    assert sorted(path.rsplit("=")[-1] for path in projected) == sorted(found)
    assert not any("Exchange" in plan for plan in projected.values())


def test_parity_moves_rows_of_broken_keys_only(spark, tmp_path, monkeypatch):
    ids = {"trial_id": "id", "sponsor_id": "if(id = 5, null, id % 3)", "nct_id": "concat('N', id)"}
    trial = spark.range(40).selectExpr(*[f"{v} {k}" for k, v in ids.items()])
    child = trial.select("trial_id")
    of = lambda key, name: child.select(F.col("trial_id").alias(key), "trial_id", F.when(F.col("trial_id") % 7 > 0, F.lit("x")).alias(name))
    tables = {
        "trial": trial, "sponsor": spark.range(3).selectExpr("id sponsor_id", "'S' sponsor_name"),
        "arm": of("arm_id", "arm_label"), "intervention": of("intervention_id", "intervention_name"), "condition": of("condition_id", "condition_name"),
        "biomarker": of("biomarker_id", "biomarker_name"), "endpoint": of("endpoint_id", "endpoint_name"), "publication": of("publication_id", "title"),
        "site": of("site_id", "facility_name").unionByName(of("site_id", "facility_name")),
    }
    nodes, edges = graph.project(tables, "s1", str(tmp_path / "graph"), AT)
    kept, cut = [], graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: kept.append(cut(df)) or kept[-1])
    at = F.col("node_id")
    faulty = nodes.filter(at != "Arm:3").withColumns({
        "label": F.when(at == "Biomarker:4", "Endpoint").otherwise(F.col("label")),
        "name": F.when((at == "Site:8") | (at == "Trial:9"), F.lit(None)).otherwise(F.col("name")),
    }).unionByName(nodes.filter(at == "Publication:6"))
    stale = edges.withColumn("source_snapshot_id", F.when(F.col("dst") == "Site:11", "s0").otherwise(F.col("source_snapshot_id")))
    found = {tuple(r) for r in graph.parity_breaks(faulty, stale, tables, "s1", buckets=1).collect()}
    assert found == {
        ("Arm", "Arm:3", "missing"), ("Biomarker", "Biomarker:4", "missing"), ("Endpoint", "Biomarker:4", "extra"), ("Publication", "Publication:6", "extra"),
        ("Site", "Site:8", "different"), ("Trial", "Trial:9", "different"), ("HAS_SITE", "Trial:11 > Site:11", "different"),
    }
    # different rows of either side, not all rows of the kinds with a break
    assert kept[-1].columns == ["row"] and kept[-1].count() == 10
