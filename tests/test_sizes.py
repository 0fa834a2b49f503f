"""What a task, the driver or a shuffle may hold: plans and pieces, on rows made here."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from trialspark.functions import text
from trialspark.operators import embed, geo, neighbours, textjobs, validate
from trialspark.plans.tables import Tables


def plan(df, which="executedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


@pytest.mark.parametrize("view", ["intervention", "condition", "endpoint", "biomarker", "publication"])
def test_parts_are_not_gathered_in_the_driver(spark, tmp_path, view):
    line = "l_orderkey long, l_partkey long, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.sql("select 1L, 2L, 'A', 'F', timestamp'2020-01-01'").toDF(*[c.split()[0] for c in line.split(", ")]).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("select 2L p_partkey, 'red rod' p_name, 'Brand#1' p_brand, 'ECON' p_type, 3 p_size").write.parquet(f"{tmp_path}/part.parquet")
    found = getattr(Tables(spark, str(tmp_path)), view)
    assert "Broadcast" not in plan(found)
    assert found.count() == 1


def test_rows_are_counted_for_broken_keys_only(spark):
    tables = {
        "trial": spark.createDataFrame([(1,), (2,), (2,)], "trial_id long"),
        "arm": spark.createDataFrame([(1, "a"), (3, "b"), (3, "b"), (None, "c")], "trial_id long, label string"),
        "site": spark.createDataFrame([(2, "a"), (None, "b")], "trial_id long, label string"),
    }
    keys = [(child, "trial_id", "trial", "trial_id") for child in ("arm", "site")]
    found = validate.referential_breaks(tables, keys)
    assert {r.foreign_key.split(".")[0]: r.orphans for r in found.collect()} == {"arm": 2, "site": 0}
    intact = validate.referential_breaks(tables, keys[1:])
    assert "Join" not in plan(intact)
    assert [r.orphans for r in intact.collect()] == [0]


def test_synonyms_are_distinct_before_they_meet(spark):
    df = spark.createDataFrame([(1, "red red rod"), (1, "Red"), (None, "rod"), (None, "rod")], "id long, t string")
    pairs = spark.createDataFrame([("red", "x"), ("red", "x"), ("rod", None), ("rod", "y")], "term string, synonym string")
    found = textjobs.expand_synonyms(df, "id", "t", pairs)
    tree = plan(found, "optimizedPlan")
    assert tree.index("Join") < tree.index("Aggregate")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(1, "red", "x"), (1, "rod", None), (1, "rod", "y"), (None, "rod", None), (None, "rod", "y")], key=str
    )


def test_words_of_a_text_move_once_and_as_text(spark):
    df = spark.createDataFrame([(1, "arm arm pulse"), (1, "pulse pulse"), (None, "visit")], "id long, t string")
    found = textjobs.top_words(df, "id", "t", 1)
    assert plan(found).count("Exchange ") == 1
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "pulse", 3, 1), (None, "visit", 1, 1)]


def test_trigrams_are_cut_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(textjobs, "DEALT_BYTES", 10)
    df = spark.createDataFrame([("Arm pulse visit.",), ("arm, pulse visit arm",), (None,), ("two words",)], "t string").coalesce(1)
    found = textjobs.trigram_counts(df, "t")
    assert "RoundRobinPartitioning(5)" in plan(found)
    assert sorted(map(tuple, found.collect())) == [("arm pulse visit", 2), ("pulse visit arm", 1)]
    assert textjobs.trigram_counts(df.limit(0), "t").count() == 0


@pytest.mark.parametrize("name", ["criteria_lines", "comparisons", "section_outline", "match_spans"])
def test_results_of_texts_are_handed_on_in_pieces(spark, name):
    function = text.match_spans(r"\w+") if name == "match_spans" else getattr(text, name)
    pieces = list(function.func(iter([pa.array(["Note:\nage > 1", None] * 150)])))
    assert max(map(len, pieces)) <= text.TEXTS_AT_ONCE
    rows = [r for p in pieces for r in p.to_pylist()]
    assert len(rows) == 300 and rows[1] == [] and rows[0] == rows[298] != []


def test_ids_of_embedded_texts_stay_exact_beside_a_null(spark):
    df = spark.createDataFrame([(2**53 + 1, "a"), (None, "b"), (7, "c")], "id long, t string").coalesce(1)
    found = embed.embed_with(df, "id", "t", lambda: lambda texts: np.ones((len(texts), 2)), batch_size=2).collect()
    assert [(r.id, list(r.embedding)) for r in found] == [(i, [1.0, 1.0]) for i in (2**53 + 1, None, 7)]


def test_scores_of_a_large_block_are_bounded():
    n, rng = 60_000, np.random.default_rng(5)
    codes = rng.integers(-9, 10, (n, 4)).astype("i1")
    rows = pa.table({"vec_id": pa.array(range(n)), "payload": pa.array([c.tobytes() for c in codes])})
    asked = pa.table({"query_id": pa.array(range(128)), "payload": pa.array([c.tobytes() for c in codes[:128]])})
    run = neighbours._best("i1", 1.0, 3, "vec_id")
    tracemalloc.start()
    found = run(rows, asked)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    scores = codes.astype(int) @ codes[127].astype(int)
    best = sorted(range(n), key=lambda i: (-scores[i], i))[:3]
    last = found.slice(127 * 3).sort_by([("points", "descending"), ("vec_id", "ascending")])
    assert last.column("vec_id").to_pylist() == best and last.column("points").to_pylist() == [scores[i] for i in best]


def test_catchment_moves_sites_once_and_makes_crowded_tiles_smaller(spark, monkeypatch):
    # six rows a degree apart along a meridian, one of them twice, a site without a trial and one without a place
    rows = [(i, i % 3 + 1, float(i), 5.0) for i in range(6)] + [(2, 3, 2.0, 5.0), (7, None, 2.0, 5.0), (8, 1, None, 5.0)]
    rows += [(20 + i, 9, 40.0, 5.0 + i / 100) for i in range(4)]
    sites = spark.createDataFrame(rows, "site_id long, trial_id long, latitude double, longitude double")
    trials = spark.createDataFrame([(i, f"NCT{i}") for i in (1, 2, 3, 9)], "trial_id long, nct_id string")
    edges, reach = [], geo.cells_in_reach
    monkeypatch.setattr(geo, "cells_in_reach", lambda df, point, edge, *a: edges.append(edge) or reach(df, point, edge, *a))
    whole = geo.site_catchment(sites, trials, 120.0)
    assert set(edges) == {8 * 120.0} and plan(whole).count("Exchange hashpartitioning") <= 3
    assert "Cogroup" not in plan(whole)
    edges.clear()
    parts = geo.site_catchment(sites, trials, 120.0, 2)
    assert sorted(set(edges)) == [240.0, 480.0, 960.0]
    # the two neighbours of a degree, a copy and the site without a trial; trials without the own one if it is not met
    expected = [(0, 1, 1, 1), (1, 2, 4, 2), (2, 3, 4, 3), (2, 3, 4, 3), (3, 1, 4, 2), (4, 2, 2, 2), (5, 3, 1, 1), (8, 1, 0, 0)]
    expected += [(20 + i, 9, 3, 1) for i in range(4)]
    for found in (whole, parts):
        assert sorted((r[0], r[1], r[3], r[4]) for r in found.collect()) == expected
    nothing = geo.site_catchment(sites.limit(0), trials, 120.0)
    assert nothing.count() == 0
