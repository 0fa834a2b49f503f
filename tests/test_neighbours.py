"""Nearest neighbours against plain NumPy."""

import numpy as np
import pytest

from trialspark.operators import neighbours


@pytest.fixture
def clustered(spark):
    """2,000 vectors around 40 centres, with ids as text and a few rows that have no direction."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 32))
    rows = [(f"v{i:04d}", (centres[i % 40] + rng.normal(scale=0.15, size=32)).tolist()) for i in range(2000)]
    odd = [("zero", [0.0] * 32), ("short", [1.0]), ("none", None), ("nan", [float("nan")] * 32), ("hole", [None] + [1.0] * 31)]
    return rows, spark.createDataFrame(rows + odd, "vec_id string, embedding array<double>")


def plain(rows, asked, k, exclude):
    ids = [i for i, _ in rows]
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    out = set()
    for q in asked:
        score = np.round(unit @ unit[ids.index(q)], 12)
        order = [i for i in np.lexsort((ids, -score)) if not (exclude and ids[i] == q)][:k]
        out |= {(q, ids[i], n + 1) for n, i in enumerate(order)}
    return out


@pytest.mark.parametrize("exclude", [True, False])
def test_exact_in_many_blocks(clustered, monkeypatch, exclude):
    rows, df = clustered
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
    asked = [i for i, _ in rows[::50]]
    got = neighbours.exact_neighbours(df, df.filter(df["vec_id"].isin(*asked, "zero", "short")), 6, exclude_self=exclude).collect()
    assert {(r["query_id"], r["vec_id"], r["rank"]) for r in got} == plain(rows, asked, 6, exclude)


def test_equal_vectors_go_by_id(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(30)], "vec_id long, embedding array<float>")
    got = neighbours.exact_neighbours(df, df.filter("vec_id = 5"), 4, exclude_self=True).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [0, 1, 2, 3]


def test_cells_skip_vectors_that_cluster(clustered, tmp_path, spark):
    rows, df = clustered
    centres = neighbours.fit_cells(df, 40)
    index = spark.read.parquet(neighbours.write_index(neighbours.cell_index(df, centres), str(tmp_path / "index")))
    assert index.count() == len(rows)
    asked = df.filter(df["vec_id"].isin(*[i for i, _ in rows[::50]]))
    probes, recall = neighbours.choose_probes(index, df, asked, centres, 10, 30)
    assert recall >= 0.9
    # full vectors met: 30 of 2,000; codes met: those of the probed cells
    cells = neighbours._cells_of(neighbours._packed(asked, "vec_id", "embedding", "i1"), "vec_id", centres, probes)
    met = cells.select("vec_id", "cell").join(index.groupBy("cell").count(), "cell").agg({"count": "sum"}).first()[0]
    assert met / (40 * len(rows)) < 0.1


def test_nothing_to_search(clustered):
    _, df = clustered
    assert neighbours.exact_neighbours(df.limit(0), df, 3).count() == 0
    assert neighbours.exact_neighbours(df, df.limit(0), 3).count() == 0
