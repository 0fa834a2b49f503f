"""Streaming jobs driven by file streams until nothing is left."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.plans.registry import query
from trialspark.plans.tables import Tables
from trialspark.session import cut_lineage, run_dir
from trialspark.sources.studies import load_studies, read_study_json, study_folders
from trialspark.streaming import landing, upserts


def _change_files(t: Tables) -> str:
    """Updates as four files in arrival order; every third row arrives a file later than its time."""
    path = run_dir(t.spark, "changes")
    day = F.dayofmonth("updated_at")
    arrival = F.least(F.floor((day - 1) / 8) + F.when(F.col("event_id") % 3 == 0, 1).otherwise(0), F.lit(3))
    df = t.updates.withColumn("arrival", arrival.cast("int"))
    for n in range(4):
        df.filter(F.col("arrival") == n).drop("arrival").coalesce(1).write.mode("append").parquet(path)
    return path


def _upserted(t: Tables, deleted: bool):
    source, target = _change_files(t), run_dir(t.spark, "current")
    schema = t.updates.schema
    stream = landing.parquet_stream(t.spark, source, schema, max_files=1)
    if deleted:
        stream = stream.withColumn("is_deleted", F.col("op") == "error")
    upserts.stream_upsert(
        stream, target, run_dir(t.spark, "offsets"), "trial_id", "updated_at",
        deleted="is_deleted" if deleted else None, tie="event_id", buckets=8,
    )
    return target


_LATEST = """SELECT trial_id, event_id, op, enrollment, {active} AS is_active FROM (SELECT *, row_number() OVER
  (PARTITION BY trial_id ORDER BY updated_at DESC, event_id DESC) AS r FROM updates) WHERE r = 1"""


@query("st01_st06_upsert", _LATEST.format(active="true"), "updates")
def upsert(t: Tables):
    """Four micro-batches with late rows: the newest row per key is left."""
    current = upserts.read_current(t.spark, _upserted(t, deleted=False))
    return current.select("trial_id", "event_id", "op", "enrollment", "is_active")


@query("st02_soft_delete", _LATEST.format(active="op <> 'error'"), "updates")
def soft_delete(t: Tables):
    current = upserts.read_current(t.spark, _upserted(t, deleted=True))
    return current.select("trial_id", "event_id", "op", "enrollment", "is_active")


@query(
    "st02_mark_missing",
    "SELECT o_custkey AS sponsor_id, bool_and(true) AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AS is_active FROM orders GROUP BY 1",
)
def missing(t: Tables):
    current = t.orders.select(F.col("o_custkey").alias("sponsor_id")).distinct().withColumn("is_active", F.lit(True))
    canonical = t.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("sponsor_id"))
    return upserts.mark_missing(current, canonical, "sponsor_id")


@query(
    "st03_sync_checkpoints",
    """WITH a AS (SELECT *, least((day(updated_at) - 1) // 8 + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END, 3) AS f FROM updates),
       b AS (SELECT unnest(range(0, 4)) AS batch_id)
       SELECT batch_id::BIGINT AS batch_id, count(DISTINCT trial_id) AS row_count, epoch_us(max(updated_at)) AS watermark_us FROM b JOIN a ON f <= batch_id GROUP BY 1""",
    "updates",
)
def checkpoints(t: Tables):
    rows = upserts.sync_checkpoints(t.spark, _upserted(t, deleted=False))
    return rows.select("batch_id", "row_count", F.unix_micros(F.col("watermark").cast("timestamp")).alias("watermark_us"))


@query(
    "st04_replay",
    """SELECT 'trial' AS family, source_snapshot_id, count(*) AS n FROM trial GROUP BY 2
       UNION ALL SELECT 'site', source_snapshot_id, count(*) FROM site JOIN trial USING (trial_id) GROUP BY 2""",
    "trial site",
)
def replay(t: Tables):
    """A full build, one snapshot again, one family again: the same rows as once.

    Each of them reads the sites, so they are built once and read from the shared folder.
    """
    sites = cut_lineage(t.site.join(t.trial.select("trial_id", "source_snapshot_id"), "trial_id"))
    families, target = {"trial": t.trial, "site": sites}, run_dir(t.spark, "replay")
    upserts.replay(families, target)
    upserts.replay(families, target, snapshot="snapshot-1996")
    upserts.replay(families, target, family="site")
    return upserts.read_families(t.spark, target, list(families))


@query(
    "st05_request_stream",
    "SELECT DISTINCT concat(user_id, '-', event_type) AS idempotency_key FROM events",
)
def requests(t: Tables):
    path, target = run_dir(t.spark, "requests"), run_dir(t.spark, "unique-requests")
    keyed = t.events.select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("idempotency_key"),
        F.col("ts").cast("timestamp").alias("requested_at"),
    )
    keyed.write.parquet(path)
    stream = landing.parquet_stream(t.spark, path, keyed.schema)
    unique = upserts.dedupe_requests(stream, "idempotency_key", "requested_at", "40 days")
    landing.land(unique, target, run_dir(t.spark, "offsets"))
    return t.spark.read.parquet(target).select("idempotency_key")


#: Files of one folder: what the driver lists at a time.
STUDIES_PER_FOLDER = 50_000


def study_files(t: Tables) -> str:
    """Every study as its own ``NCT….json`` file, written by the tasks into folders of the shared one.

    The folder must be mounted on the executors, since the files are named by their key.
    """
    path = run_dir(t.spark, "studies").removeprefix("file:")

    def write(batches):
        import os

        made = set()
        for batch in batches:
            for key, folder, text in zip(batch["nct_id"], batch["folder"], batch["study_json"]):
                if folder not in made:
                    os.makedirs(f"{path}/folder-{folder}", exist_ok=True)
                    made.add(folder)
                with open(f"{path}/folder-{folder}/{key}.json", "w", encoding="utf-8") as file:
                    file.write(text)
            yield batch[["nct_id"]]

    folders = max(1, -(-t.raw_json.count() // STUDIES_PER_FOLDER))
    dealt = t.raw_json.withColumn("folder", F.pmod(F.xxhash64("nct_id"), F.lit(folders)))
    dealt.repartition(max(8, folders)).mapInPandas(write, "nct_id string").count()
    return "file://" + path


_TITLES = """SELECT nct_id, json_extract_string(study_json, '$.protocolSection.identificationModule.officialTitle') AS official_title,
  strlen(study_json)::BIGINT AS size_bytes FROM raw_json"""


def _titles(raw):
    good, _ = load_studies(raw)
    return good.select(
        "nct_id", F.col("study.protocolSection.identificationModule.officialTitle").alias("official_title"),
        F.octet_length("study_json").cast("bigint").alias("size_bytes"),
    )


@query("src02_json_file_scan", _TITLES, "raw_json")
def json_files(t: Tables):
    return _titles(read_study_json(t.spark, study_files(t)))


@query("st07_land_study_files", _TITLES, "raw_json")
def land_files(t: Tables):
    """Each folder as a stream of new files, landed as Parquet over several batches."""
    target, offsets = run_dir(t.spark, "landed"), run_dir(t.spark, "offsets")
    landed = []
    for n, folder in enumerate(study_folders(t.spark, study_files(t))):
        stream = landing.study_file_stream(t.spark, folder, max_files=8000)
        landing.land(stream, f"{target}/{n}", f"{offsets}/{n}")
        landed.append(t.spark.read.parquet(f"{target}/{n}"))
    return _titles(reduce(DataFrame.unionByName, landed))
