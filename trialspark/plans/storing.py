"""Writers, read back: tables, marts, shards, artifacts, reports."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from trialspark.plans.harmonizing import RUN_TS, harmonized
from trialspark.plans.registry import query
from trialspark.plans.tables import Tables
from trialspark.session import run_dir
from trialspark.sources import history, marts, studies, writers


@query(
    "src01_csv_scan",
    """SELECT nct_number AS nct_id, study_title AS title, conditions, enrollment, start_date FROM raw_csv""",
    "raw_csv",
)
def csv_scan(t: Tables):
    """The studies written as CSV and scanned back with the fixed header schema."""
    path = run_dir(t.spark, "csv")
    have = t.csv_with_headers()
    from trialspark.schemas import CSV_TO_HARMONIZED

    full = have.select(
        *[(F.col(h) if h in have.columns else F.lit(None).cast("string")).alias(h) for h in CSV_TO_HARMONIZED]
    )
    full.write.option("header", True).option("escape", '"').csv(path)
    back = studies.read_study_csv(t.spark, path).withColumnsRenamed(CSV_TO_HARMONIZED)
    return back.select("nct_id", "title", "conditions", "enrollment", "start_date")


@query(
    "src03_src04_write_and_scan",
    """SELECT o_orderkey AS trial_id, lower(o_orderpriority) AS label FROM orders""",
)
def write_and_scan(t: Tables):
    path = writers.write_table(
        t.orders.select(F.col("o_orderkey").alias("trial_id"), F.lower("o_orderpriority").alias("label")),
        run_dir(t.spark, "table"),
    )
    return t.spark.read.parquet(path)


def _export(t: Tables) -> str:
    base = run_dir(t.spark, "marts")
    tables = sorted(set(marts.FACT_SOURCES.values()))
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        list(pool.map(lambda table: getattr(t, table).write.parquet(f"{base}/canonical/{table}.parquet"), tables))
    again = {"trial_fact": "trial"}
    for snapshot, mapping in (("snapshot-a", again), ("snapshot-a", None), ("snapshot-b", None)):
        marts.export_marts(t.spark, f"{base}/canonical", f"{base}/out", snapshot, mapping, RUN_TS)
    return base


@query(
    "src05_src06_ag08_mart_export",
    " UNION ALL ".join(
        f"SELECT '{fact}' AS fact_table, s AS source_snapshot_id, count(*) AS row_count FROM {table}, "
        "(VALUES ('snapshot-a'), ('snapshot-b')) v(s) GROUP BY 1, 2"
        for fact, table in marts.FACT_SOURCES.items()
    ),
    "trial arm endpoint site publication",
)
def mart_export(t: Tables):
    """Two snapshots; the trials of one are exported twice, and their partition is replaced."""
    return marts.mart_counts(t.spark, f"{_export(t)}/out")


@query(
    "src05_trial_fact_rows",
    """SELECT trial_id, nct_id, source_snapshot_id AS origin_snapshot_id, 'snapshot-a' AS source_snapshot_id, 1704067200000000::BIGINT AS exported_us FROM trial""",
    "trial",
)
def trial_fact(t: Tables):
    path = writers.write_partitioned(marts.mart_rows(t.trial, "snapshot-a", RUN_TS), run_dir(t.spark, "trial-fact"))
    back = t.spark.read.parquet(path)
    return back.select(
        "trial_id", "nct_id", "origin_snapshot_id", F.col("source_snapshot_id").cast("string").alias("source_snapshot_id"),
        F.unix_micros("exported_at").alias("exported_us"),
    )


@query(
    "src07_mart_lineage",
    " UNION ALL ".join(
        f"SELECT '{fact}' AS fact_table, '{table}' AS source_table, 'source_snapshot_id' AS partition_key, count(*) AS source_rows FROM {table}"
        for fact, table in marts.FACT_SOURCES.items()
    ),
    "trial arm endpoint site publication",
)
def mart_lineage(t: Tables):
    """The lineage map as written, with the rows of each source it names."""
    base = _export(t)
    mapped = t.spark.read.schema(
        "fact_table string, source_table string, source_parquet string, fact_parquet_dir string, partition_key string"
    ).json(f"{base}/out/mart_lineage_map")
    rows = [
        t.spark.read.parquet(f"{base}/canonical/{table}.parquet").agg(F.count("*").alias("source_rows")).select(
            F.lit(table).alias("source_table"), "source_rows"
        )
        for table in marts.FACT_SOURCES.values()
    ]
    counted = rows[0]
    for other in rows[1:]:
        counted = counted.unionByName(other)
    return mapped.join(counted, "source_table").select("fact_table", "source_table", "partition_key", "source_rows")


@query(
    "src08_artifact_catalogue",
    """SELECT sha256(text) AS sha256, concat(substr(sha256(text), 1, 2), '/', sha256(text), '.txt') AS raw_artifact_path,
         max(strlen(text))::BIGINT AS file_size, count(*) AS copies FROM documents GROUP BY 1, 2""",
)
def artifacts(t: Tables):
    """Document texts as landed files; equal contents are one artifact."""
    files = t.documents.select(
        F.concat(F.lit("landed/doc_"), F.col("doc_id").cast("string"), F.lit(".TXT")).alias("path"),
        F.octet_length("text").cast("bigint").alias("length"), F.encode("text", "UTF-8").alias("content"),
    )
    return writers.catalogue_artifacts(files)


@query(
    "src08_artifact_store",
    """SELECT sha256(text) AS sha256, concat(substr(sha256(text), 1, 2), '/', sha256(text), '.txt') AS raw_artifact_path,
         max(strlen(text))::BIGINT AS file_size, md5(text) AS content_md5 FROM documents WHERE text IS NOT NULL AND doc_id % 2 = 1 GROUP BY 1, 2, 4""",
)
def artifact_store(t: Tables):
    """Texts stored by hash in two runs, the second with all of the first; contents read back by hash."""
    files = t.documents.filter("text is not null").select(
        F.concat(F.lit("landed/doc_"), F.col("doc_id").cast("string"), F.lit(".TXT")).alias("path"),
        F.octet_length("text").cast("bigint").alias("length"), F.encode("text", "UTF-8").alias("content"), "doc_id",
    )
    path = run_dir(t.spark, "artifacts")
    writers.store_artifacts(files.filter("doc_id % 3 = 0"), path)
    writers.store_artifacts(files, path)
    wanted = files.filter("doc_id % 2 = 1").select(F.sha2("content", 256).alias("sha256"))
    found = writers.read_stored(t.spark, path, wanted)
    return found.select("sha256", "raw_artifact_path", "file_size", F.md5("content").alias("content_md5"))


@query(
    "src09_sharded_write",
    """SELECT (concat('0x', substr(md5(nct_id), 1, 8))::BIGINT % 256)::BIGINT AS shard_id, count(*) AS record_count FROM trial GROUP BY 1""",
    "trial",
)
def shards(t: Tables):
    counts = writers.write_shards(t.trial, "nct_id", run_dir(t.spark, "shards"))
    return counts.withColumn("shard_id", F.col("shard_id").cast("bigint"))


# the trials as three runs saw them: rows leave, come and change from one to the next
_RUNS = [
    ("trial_id % 10 <> 0", "enrollment"),
    ("trial_id % 9 <> 0", "CASE WHEN trial_id % 7 = 0 THEN enrollment + 1 ELSE enrollment END"),
    ("trial_id % 9 <> 0 AND trial_id % 11 <> 0", "CASE WHEN trial_id % 7 = 0 THEN enrollment + 1 ELSE enrollment END"),
]


def _recorded(t: Tables) -> str:
    path = run_dir(t.spark, "runs")
    for n, (where, value) in enumerate(_RUNS):
        state = t.trial.filter(where).select("trial_id", "nct_id", F.expr(value).alias("enrollment"), "source_snapshot_id")
        history.write_run(state, path, n, "trial_id")
    return path


@query(
    "src10_versioned_table",
    " UNION ALL ".join(
        f"SELECT {n}::BIGINT AS run, source_snapshot_id, count(*) AS n, sum({value})::BIGINT AS enrollment FROM trial WHERE {where} GROUP BY 2"
        for n, (where, value) in enumerate(_RUNS)
    ),
    "trial",
)
def versioned(t: Tables):
    """Every run read back: the first from its base, the others from the base and their deltas."""
    path = _recorded(t)
    read = [
        history.read_run(t.spark, path, n).groupBy("source_snapshot_id").agg(F.count("*").alias("n"), F.sum("enrollment").alias("enrollment")).select(
            F.lit(n).cast("bigint").alias("run"), "source_snapshot_id", "n", "enrollment"
        )
        for n in range(len(_RUNS))
    ]
    return read[0].unionByName(read[1]).unionByName(read[2])


@query(
    "src10_run_deltas",
    f"""WITH s AS ({" UNION ALL ".join(f"SELECT {n} AS run, trial_id, {value} AS e FROM trial WHERE {where}" for n, (where, value) in enumerate(_RUNS))}),
        d AS (SELECT b.run, a.trial_id AS old, b.trial_id AS new, a.e AS e1, b.e AS e2 FROM s b LEFT JOIN s a ON a.trial_id = b.trial_id AND a.run = b.run - 1
          UNION ALL SELECT a.run + 1, a.trial_id, NULL, a.e, NULL FROM s a LEFT JOIN s b ON a.trial_id = b.trial_id AND b.run = a.run + 1
          WHERE b.trial_id IS NULL AND a.run < 2)
        SELECT run::BIGINT AS run, CASE run WHEN 0 THEN 'base' ELSE 'delta' END AS kind, count(*) FILTER (WHERE old IS NULL) AS inserted,
          count(*) FILTER (WHERE old IS NOT NULL AND new IS NOT NULL AND e1 IS DISTINCT FROM e2) AS updated,
          count(*) FILTER (WHERE new IS NULL) AS deleted FROM d GROUP BY 1, 2""",
    "trial",
)
def deltas(t: Tables):
    return history.runs(t.spark, _recorded(t)).select("run", "kind", "inserted", "updated", "deleted")


@query(
    "src11_run_report",
    """SELECT 'harmonization' AS section, (SELECT count(*) FROM (SELECT nct_number FROM raw_csv UNION SELECT nct_id FROM raw_json)) AS records
       UNION ALL SELECT 'documents', count(*) FROM documents""",
    "raw_csv raw_json",
)
def report(t: Tables):
    sections = {
        "harmonization": harmonized(t, "json_priority").agg(F.count("*").alias("records")),
        "documents": t.documents.agg(F.count("*").alias("records")),
    }
    path = writers.write_report(sections, run_dir(t.spark, "report"))
    back = t.spark.read.schema("section string, statistics string").json(path)
    return back.select("section", F.get_json_object("statistics", "$.records").cast("bigint").alias("records"))
