import datetime
import json
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trialspark.plans import registry, streams
from trialspark.plans.tables import Tables
from trialspark.sources import marts, studies, writers
from trialspark.streaming import landing, upserts


def test_json_folder_keeps_bad_files_aside(spark, tmp_path):
    (tmp_path / "NCT001.json").write_text(json.dumps({"protocolSection": {"identificationModule": {"nctId": "NCT001"}}}))
    (tmp_path / "NCT002.json").write_text('{\n "hasResults": true\n}')
    (tmp_path / "NCT003.json").write_text("{broken")
    (tmp_path / "notes.json").write_text("{}")
    good, bad = studies.load_studies(studies.read_study_json(spark, str(tmp_path)))
    assert {r["nct_id"] for r in good.collect()} == {"NCT001", "NCT002"}
    assert [tuple(r) for r in bad.collect()] == [("NCT003", "{broken")]


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    from trialspark.schemas import CSV_TO_HARMONIZED

    header = ",".join(CSV_TO_HARMONIZED)
    cells = ["NCT1", '"A ""quoted"" title,\nin two lines"'] + [""] * (len(CSV_TO_HARMONIZED) - 2)
    (tmp_path / "s.csv").write_text(f"{header}\n{','.join(cells)}\n")
    row = studies.read_study_csv(spark, str(tmp_path / "s.csv")).first()
    assert row["NCT Number"] == "NCT1" and row["Study Title"] == 'A "quoted" title,\nin two lines' and row["Sex"] is None


def test_marts(spark, tmp_path):
    source, out = tmp_path / "canonical", tmp_path / "out"
    columns = {"trial": "nct_id", "arm": "arm_label", "endpoint": "endpoint_name", "site": "country", "publication": "journal"}
    for name, column in list(columns.items())[:-1]:
        spark.createDataFrame([(1, "a"), (2, "b")], f"id long, {column} string").write.parquet(f"{source}/{name}.parquet")
    with pytest.raises(FileNotFoundError, match="publication"):
        marts.export_marts(spark, str(source), str(out), "s1")
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, journal string").write.parquet(f"{source}/publication.parquet")
    counts = marts.export_marts(spark, str(source), str(out), "s1").collect()
    assert {(r["fact_table"], r["row_count"]) for r in counts} == {(f, 2) for f in marts.FACT_SOURCES}
    assert (out / "trial_fact" / "source_snapshot_id=s1").is_dir()
    marts.export_marts(spark, str(source), str(out), "s2", {"trial_fact": "trial"})
    marts.export_marts(spark, str(source), str(out), "s2", {"trial_fact": "trial"})
    assert spark.read.parquet(f"{out}/trial_fact").count() == 4


def test_artifact_names(spark, tmp_path):
    for name, content in {"A.PDF": b"one", "b.pdf": b"one", "noext": b"two"}.items():
        (tmp_path / name).write_bytes(content)
    rows = writers.catalogue_artifacts(writers.read_artifacts(spark, str(tmp_path))).collect()
    assert sorted((r["raw_artifact_path"].rsplit(".")[-1], r["file_size"], r["copies"]) for r in rows) == [
        ("bin", 3, 1), ("pdf", 3, 2),
    ]
    assert all(r["raw_artifact_path"].startswith(r["sha256"][:2] + "/" + r["sha256"]) for r in rows)


def test_contents_are_stored_once_by_hash(spark, tmp_path):
    landed, store = tmp_path / "landed", str(tmp_path / "store")
    landed.mkdir()
    for name, content in {"A.PDF": b"one", "b.pdf": b"one", "noext": b"two"}.items():
        (landed / name).write_bytes(content)
    files = lambda: writers.read_artifacts(spark, str(landed))
    writers.store_artifacts(files(), store)
    before = files_of(tmp_path / "store")
    (landed / "c.txt").write_bytes(b"three")
    catalogue = writers.store_artifacts(files(), store)
    after = files_of(tmp_path / "store")
    assert before.items() <= after.items() and len(after) == len(before) + 1
    assert spark.read.parquet(store).count() == 3
    back = {bytes(r["content"]): r["raw_artifact_path"] for r in writers.read_stored(spark, store, catalogue).collect()}
    assert set(back) == {b"one", b"two", b"three"} and back[b"three"].endswith(".txt")
    assert writers.read_stored(spark, store, catalogue.limit(0)).count() == 0


def test_shards_with_one_hot_key(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    counts = writers.write_shards(df, "k", str(tmp_path / "shards"), 16).collect()
    assert sum(r["record_count"] for r in counts) == 3000
    assert max(r["record_count"] for r in counts) >= 1000


SCHEMA = "k long, v string, at timestamp, gone boolean"


def at(minute):
    return datetime.datetime(2024, 1, 1, 0, minute)


def test_stream_upsert_late_rows_deletes_and_restart(spark, tmp_path):
    source, target, offsets = (str(tmp_path / n) for n in ("in", "target", "offsets"))
    run = lambda: upserts.stream_upsert(
        landing.parquet_stream(spark, source, SCHEMA, max_files=1), target, offsets, "k", "at", deleted="gone"
    )
    batch = lambda rows: spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    current = lambda: {r["k"]: (r["v"], r["is_active"]) for r in upserts.read_current(spark, target).collect()}
    batch([(1, "a", at(10), False), (2, "b", at(10), False), (1, "a0", at(5), False)])
    run()
    assert current() == {1: ("a", True), 2: ("b", True)}
    batch([(1, "late", at(7), False), (2, "b", at(20), True), (3, "c", at(1), False)])
    run()
    assert current() == {1: ("a", True), 2: ("b", False), 3: ("c", True)}
    rows = upserts.sync_checkpoints(spark, target).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["row_count"], r["active_count"]) for r in rows] == [(0, 2, 2), (1, 3, 2)]
    changes = spark.createDataFrame([(9, "again", at(59), False)], SCHEMA)
    upserts.apply_batch(changes, 1, target, "k", "at", "gone", None)  # a recorded batch is not applied again
    assert set(current()) == {1, 2, 3}
    run()
    assert upserts.sync_checkpoints(spark, target).count() == 2


def test_mark_missing_drops_nothing(spark):
    current = spark.createDataFrame([(1, True), (2, True), (3, False)], "k long, is_active boolean")
    marked = upserts.mark_missing(current, spark.createDataFrame([(1,), (1,), (3,)], "k long"), "k")
    assert {tuple(r) for r in marked.collect()} == {(1, True), (2, False), (3, False)}


def test_landing_is_exactly_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, offsets = str(tmp_path / "landed"), str(tmp_path / "offsets")
    for n in range(3):
        (source / f"NCT{n}.json").write_text('{"hasResults": false}')
        landing.land(landing.study_file_stream(spark, str(source)), target, offsets)
    assert sorted(r["nct_id"] for r in spark.read.parquet(target).collect()) == ["NCT0", "NCT1", "NCT2"]


def test_requests_are_unique_over_restarts(spark, tmp_path):
    source, target, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    schema = "idempotency_key string, requested_at timestamp"
    for rows in ([("a", at(1)), ("b", at(2)), ("a", at(3))], [("a", at(4)), ("c", at(5))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = landing.parquet_stream(spark, source, schema)
        landing.land(upserts.dedupe_requests(stream, "idempotency_key", "requested_at", "1 hour"), target, offsets)
    assert sorted(r["idempotency_key"] for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]


def files_of(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_a_batch_writes_only_the_buckets_of_its_keys(spark, tmp_path):
    target = tmp_path / "target"
    schema = "k long, v string, at timestamp, source_snapshot_id string, notes map<string,string>"
    write = lambda rows, n: upserts.apply_batch(
        spark.createDataFrame(rows, schema), n, str(target), "k", "at", None, None, buckets=16, snapshot="source_snapshot_id", keep=3
    )
    write([(k, "a", at(1), "s1", {}) for k in range(200)], 0)
    before = files_of(target / "data")
    write([(7, "b", at(2), "s2", {"x": "y"}), (8, "late", at(0), "s0", {}), (7, "b2", at(2), "s2", {})], 1)
    after = files_of(target / "data")
    assert before.items() <= after.items()  # no file of the first batch was written again
    own = {p.parent.name for p in set(after) - set(before)}
    assert 1 <= len(own) <= 2
    rows = {r["k"]: r["v"] for r in upserts.read_current(spark, str(target)).collect()}
    assert len(rows) == 200 and rows[7] == "b2" and rows[8] == "a"
    assert {r["v"] for r in upserts.read_current(spark, str(target), 0).collect()} == {"a"}
    marks = upserts.sync_checkpoints(spark, str(target)).orderBy("batch_id").collect()
    assert [(r["row_count"], r["watermark"], r["snapshot_watermark"]) for r in marks] == [(200, at(1), "s1"), (200, at(2), "s2")]


def test_failed_batch_changes_nothing_and_old_versions_expire(spark, tmp_path, monkeypatch):
    from trialspark.sources import versioned

    target = str(tmp_path / "target")
    write = lambda v, n: upserts.apply_batch(spark.createDataFrame([(1, v, at(n), False), (2 + n, v, at(n), False)], SCHEMA), n, target, "k", "at", "gone", None, buckets=4)
    write("a", 0)
    with monkeypatch.context() as m:
        m.setattr(versioned, "manifest", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write("lost", 1)
    assert {(r["k"], r["v"]) for r in upserts.read_current(spark, target).collect()} == {(1, "a"), (2, "a")}
    for n in range(1, 5):
        write(f"v{n}", n)
    assert {(r["k"], r["v"]) for r in upserts.read_current(spark, target).collect()} == {
        (1, "v4"), (2, "a"), (3, "v1"), (4, "v2"), (5, "v3"), (6, "v4"),
    }
    kept = {(r["in_version"], r["part"]) for v in (3, 4) for r in versioned.manifest(spark, target, v).collect()}
    folders = {(int(p.parent.name[8:]), p.name[6:]) for p in (tmp_path / "target" / "data").glob("*/_part=*")}
    assert folders == kept


def test_no_sort_aggregate_in_an_upsert(spark):
    current = spark.createDataFrame([(1, "a", at(1), True)], "k long, v string, at timestamp, is_active boolean")
    changes = spark.createDataFrame([(1, "b", at(2), True), (2, "c", at(2), False)], SCHEMA)
    merged = upserts.upsert_batch(current, changes, "k", "at", "gone")
    assert {(r["k"], r["v"], r["is_active"]) for r in merged.collect()} == {(1, "b", False), (2, "c", True)}
    assert "SortAggregate" not in merged._jdf.queryExecution().executedPlan().toString()
    again = upserts.upsert_batch(merged, changes, "k", "at", "gone")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_changes_past_a_watermark(spark):
    df = spark.createDataFrame([(1, at(1), "s1"), (2, at(2), "s1"), (3, at(1), "s2")], "k long, at timestamp, snap string")
    assert {r["k"] for r in upserts.changes_since(df, "at", "snap", (at(1), "s1")).collect()} == {2, 3}
    assert upserts.changes_since(df, "at", "snap", None).count() == 3


def test_replay_removes_snapshots_that_left_the_source(spark, tmp_path):
    before = spark.createDataFrame([(1, "s1"), (2, "s2"), (3, "s3"), (4, "s4")], "id long, source_snapshot_id string")
    target = str(tmp_path)
    ids = lambda: sorted(r["id"] for r in upserts.versioned.read_version(spark, f"{target}/site").collect())
    upserts.replay({"site": before}, target)
    upserts.replay({"site": before.where("id = 2")}, target)
    assert ids() == [2]
    upserts.replay({"site": before}, target, snapshot="s1")
    assert ids() == [1, 2]
    upserts.replay({"site": before.where("id <> 2")}, target, snapshot="s2", until="s3")
    assert ids() == [1, 3]
    upserts.replay({"site": before.limit(0)}, target)
    assert ids() == []


def test_replay_may_read_its_target_and_may_fail(spark, tmp_path):
    before = spark.createDataFrame([(1, "s1"), (2, "s2")], "id long, source_snapshot_id string")
    target = str(tmp_path)
    read = lambda: upserts.versioned.read_version(spark, f"{target}/site")
    upserts.replay({"site": before}, target)
    upserts.replay({"site": read().withColumn("id", F.col("id") + 10)}, target)
    assert sorted(r["id"] for r in read().collect()) == [11, 12]
    broken = before.withColumn("id", F.expr("raise_error('no')").cast("long"))
    with pytest.raises(Exception, match="no"):
        upserts.replay({"site": broken}, target)
    assert sorted(r["id"] for r in read().collect()) == [11, 12]


def test_history_of_runs(spark, tmp_path):
    from trialspark.sources import history

    path = str(tmp_path / "history")
    table = lambda rows: spark.createDataFrame(rows, "id long, v string")
    states = [{1: "a", 2: "b"}, {1: "a", 2: "B", 3: "c"}, {2: "B", 3: "c"}, {1: "back", 2: "B"}, {1: "back"}]
    kinds = [history.write_run(table(list(s.items())), path, n, "id", base_every=4) for n, s in enumerate(states)]
    assert kinds == ["base", "delta", "delta", "delta", "base"]
    assert history.write_run(table([(9, "again")]), path, 2, "id") == "delta"  # recorded: not written again
    for n, state in enumerate(states):
        assert {r["id"]: r["v"] for r in history.read_run(spark, path, n).collect()} == state
    counts = {r["run"]: (r["inserted"], r["updated"], r["deleted"]) for r in history.runs(spark, path).collect()}
    assert counts == {0: (2, 0, 0), 1: (1, 1, 0), 2: (0, 0, 1), 3: (1, 0, 1), 4: (1, 0, 0)}
    assert history.compact(spark, path, 4) and {r["id"] for r in history.read_run(spark, path).collect()} == {1}
    with pytest.raises(ValueError):
        history.read_run(spark, path, 77)


def study_orders(spark, path, n=9):
    rows = [(i, 1000 + i, f"{i % 5}-LOW") for i in range(1, n + 1)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{path}/orders.parquet")
    return {f"NCT{i:08d}" for i, _, _ in rows if i % 4}


def test_study_files_are_listed_a_folder_at_a_time(spark, tmp_path, monkeypatch):
    expected = study_orders(spark, tmp_path)
    monkeypatch.setattr(streams, "STUDIES_PER_FOLDER", 2)
    t = Tables(spark, str(tmp_path))
    path = streams.study_files(t)
    folders = studies.study_folders(spark, path)
    assert len(folders) > 1 and not list(Path(path.removeprefix("file://")).glob("*.json"))
    read = studies.read_study_json(spark, path)
    assert not any("folder-" in f for f in read.inputFiles())  # kept before the next folder is listed
    assert sorted(r.nct_id for r in read.collect()) == sorted(expected)
    assert sorted(r.nct_id for r in streams.json_files(t).collect()) == sorted(expected)
    assert sorted(r.nct_id for r in streams.land_files(t).collect()) == sorted(expected)


def test_files_of_a_batch_are_looked_up_by_few_tasks(spark, tmp_path):
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    source = tmp_path / "in"
    source.mkdir()
    n = 40 + 4 * spark.sparkContext.defaultParallelism
    for i in range(n):
        (source / f"NCT{i:08d}.json").write_text("{}")
    before = spark.conf.get(key)
    tracker = spark.sparkContext.statusTracker()
    most, done = [], threading.Event()

    def watch():
        while not done.wait(0.01):
            most.extend(i.numTasks for s in tracker.getActiveStageIds() if (i := tracker.getStageInfo(s)) is not None)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        landing.land(landing.study_file_stream(spark, str(source), n), str(tmp_path / "out"), str(tmp_path / "offsets"))
    finally:
        done.set()
        watcher.join()
    assert spark.read.parquet(str(tmp_path / "out")).count() == n
    assert most and max(most) < n
    assert spark.conf.get(key) == before


def test_replays_read_the_sites_from_files(spark, tmp_path, monkeypatch):
    rows = {
        "orders": "select 1L o_orderkey, 7L o_custkey, 'F' o_orderstatus, 5D o_totalprice, timestamp'1996-02-03' o_orderdate "
        "union all select 2L, 7L, 'O', 5D, timestamp'1997-02-03'",
        "lineitem": "select o l_orderkey, s l_suppkey from values (1L, 1L), (1L, 1L), (1L, 2L), (2L, 1L), (3L, 1L) as v(o, s)",
        "supplier": "select s s_suppkey, concat('S', s) s_name, 1L s_nationkey from values (1L), (2L) as v(s)",
        "nation": "select 1L n_nationkey, 'Wales' n_name, 1L n_regionkey", "region": "select 1L r_regionkey, 'EUROPE' r_name",
    }
    for name, sql in rows.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    plans, rebuild = [], upserts.replay

    def seen(families, target, **only):
        plans.append(families["site"]._jdf.queryExecution().optimizedPlan().toString())
        return rebuild(families, target, **only)

    monkeypatch.setattr(upserts, "replay", seen)
    found = registry.load()[0]["st04_replay"](spark, str(tmp_path))
    assert len(plans) == 3 and not any("Join" in p or "Aggregate" in p for p in plans)
    assert sorted(map(tuple, found.collect())) == [
        ("site", "snapshot-1996", 2), ("site", "snapshot-1997", 1), ("trial", "snapshot-1996", 1), ("trial", "snapshot-1997", 1),
    ]
