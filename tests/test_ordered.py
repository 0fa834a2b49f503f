"""Ordered work over keys and times that hold most of the rows."""

import datetime

from pyspark.sql import functions as F

from trialspark.operators import lineage, ordered, scd

START = datetime.datetime(2024, 1, 1)


def skewed(spark):
    """Half of 40,000 rows have one key and one timestamp, a few have no key."""
    n = F.col("id")
    return spark.range(40_000).select(
        F.when(n % 2 == 0, 1).when(n % 1000 == 1, None).otherwise(n % 97 + 2).alias("k"),
        F.when(n % 2 == 0, F.lit(START)).otherwise(F.timestamp_seconds(F.lit(1_704_067_200) + n % 5000)).alias("at"),
        n.alias("event"), (n % 7).cast("string").alias("v"),
    )


def test_largest_piece_is_near_the_mean(spark):
    placed = ordered.with_pieces(skewed(spark), "k", "at", "event", pieces=40)
    sizes = [r["count"] for r in placed.groupBy("k", "_b").count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 2 * 40_000 / 40
    # pieces follow each other in order
    edges = placed.filter("k = 1").groupBy("_b").agg(F.min("event").alias("a"), F.max("event").alias("z")).orderBy("_b").collect()
    assert len(edges) > 20 and all(x["z"] < y["a"] for x, y in zip(edges, edges[1:]))


def test_versions_of_a_key_with_one_timestamp(spark):
    got = scd.build_scd2(skewed(spark), "k", "at", ["v"], "event", pieces=40)
    rows = {r["event"]: r for r in got.collect()}
    assert len(rows) == 40_000
    hot = sorted(e for e, r in rows.items() if r["k"] == 1)
    assert [rows[e]["version_number"] for e in hot] == list(range(1, len(hot) + 1))
    assert [rows[e]["is_current"] for e in hot[-2:]] == [False, True]
    for before, e in zip(hot, hot[1:]):
        old = rows[before]["v"]
        assert rows[e]["changed_fields"] == ({"v": (old, rows[e]["v"])} if old != rows[e]["v"] else {})
    nobody = sorted((r["at"], e) for e, r in rows.items() if r["k"] is None)
    assert [rows[e]["version_number"] for _, e in nobody] == list(range(1, len(nobody) + 1))


def test_values_carried_over_pieces(spark):
    df = skewed(spark).withColumn("v", F.when(F.col("event") % 400 == 0, F.col("event").cast("string")))
    got = {r["event"]: r["v"] for r in ordered.carry_forward(df, "k", "at", "event", "v", pieces=40).filter("k = 1").collect()}
    assert got == {e: str(e - e % 400) for e in range(0, 40_000, 2)}


def test_first_rows_without_sorting_all(spark):
    got = scd.first_request(skewed(spark).withColumnRenamed("k", "key"), "key", "at", "event")
    assert got.count() == 98 + 1
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_register_rows_with_maps(spark):
    new = spark.createDataFrame([("a", 2, {"x": 1}), ("a", 1, {"y": 2}), ("b", 5, {})], "k string, n int, m map<string,int>")
    known = spark.createDataFrame([("b",)], "k string")
    assert [(r["k"], r["n"]) for r in lineage.register(known, new, ["k"]).collect()] == [("a", 1)]


def test_percentiles_of_many_distinct_values(spark):
    n = F.col("id")
    df = spark.range(30_000).select(
        F.when(n % 3 > 0, "hot").when(n % 1000 == 0, None).otherwise(F.concat(F.lit("g"), (n % 5).cast("string"))).alias("g"),
        F.when(n % 11 > 0, (n * 7919 % 30_011) / 7).alias("v"),
    )
    for p in (0.0, 0.37, 0.5, 0.95, 1.0):
        got = {r["g"]: r["percentile"] for r in ordered.exact_percentile(df, "v", p, "g", pieces=40).collect()}
        want = {r["g"]: r["w"] for r in df.groupBy("g").agg(F.percentile("v", F.lit(p)).alias("w")).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    whole = ordered.exact_percentile(df, "v", 0.95).first()
    assert abs(whole["percentile"] - df.agg(F.percentile("v", F.lit(0.95))).first()[0]) < 1e-9
    assert ordered.exact_percentile(df.filter("v is null"), "v", 0.5).count() == 0


def test_delta_of_repeated_and_missing_keys(spark):
    schema = "k int, a string, b double"
    old = spark.createDataFrame([(1, "x", 1.0), (2, "x", None), (3, "x", 1.0), (5, "p", 1.0), (5, "q", 1.0), (None, "n", 0.0), (None, "n", 0.0)], schema)
    new = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0), (4, "x", 1.0), (5, "q", 1.0), (5, "p", 1.0), (None, "n", 0.0)], schema)
    got = sorted((str(r["k"]), r["change"], tuple(r["changed_columns"])) for r in lineage.snapshot_delta(old, new, "k").collect())
    assert got == sorted([
        ("1", "unchanged", ()), ("2", "updated", ("a", "b")), ("3", "deleted", ()), ("4", "inserted", ()), ("5", "unchanged", ()),
        ("None", "deleted", ()), ("None", "deleted", ()), ("None", "inserted", ()),
    ])


def test_delta_with_a_third_of_keys_missing_and_one_key_repeated(spark):
    k = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id"))
    old = spark.range(9000).select(k.alias("k"), (F.col("id") % 5).alias("v"))
    new = old.withColumn("v", F.when(F.col("k") == 8, 99).otherwise(F.col("v")))
    counts = {r["change"]: r["count"] for r in lineage.snapshot_delta(old, new, "k").groupBy("change").count().collect()}
    assert counts == {"deleted": 3000, "inserted": 3000, "unchanged": 3000, "updated": 1}
