"""Document statistics, the quality gate, gate results and workload decisions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark.functions.scalars import parse_document, url_filename
from trialspark.operators.ordered import exact_percentile


@dataclass(frozen=True)
class QualityThresholds:
    min_studies_processed: int = 100_000
    max_error_rate: float = 0.05
    min_avg_tokens: float = 50
    min_lexical_diversity: float = 0.1


def explode_documents(df: DataFrame, snapshot_id: str | None = None) -> DataFrame:
    """One pending row per document of a study."""
    document = df.filter(F.array_size("document_urls") > 0).select(
        "nct_id", F.explode("document_urls").alias("_d")
    )
    parsed = document.select("nct_id", parse_document("_d").alias("_p")).select("nct_id", "_p.*")
    null = lambda t: F.lit(None).cast(t)
    return parsed.select(
        "nct_id",
        "document_type",
        "url",
        url_filename("url").alias("filename"),
        null("string").alias("local_path"),
        null("bigint").alias("file_size"),
        F.lit("pending").alias("status"),
        null("string").alias("error"),
        F.lit(snapshot_id).cast("string").alias("source_snapshot_id"),
        null("string").alias("source_content_sha256"),
        null("string").alias("raw_artifact_path"),
        null("timestamp").alias("source_fetched_at"),
    )


def document_statistics(documents: DataFrame) -> DataFrame:
    """Counts by status, size of downloaded files in MB, and studies with documents."""
    status = F.col("status")
    return documents.agg(
        F.count("*").alias("total_documents"),
        F.count_if(status == "downloaded").alias("downloaded"),
        F.count_if(status == "failed").alias("failed"),
        F.count_if(status == "skipped").alias("skipped"),
        (F.coalesce(F.sum(F.when(status == "downloaded", F.col("file_size"))), F.lit(0)) / 1048576.0).alias(
            "total_size_mb"
        ),
        F.count_distinct("nct_id").alias("studies_with_documents"),
    )


def snapshot_summary(documents: DataFrame, snapshot_id: str) -> DataFrame:
    """One row per run, also for no documents; the size covers every status."""
    status = F.col("status")
    return documents.agg(
        F.lit(snapshot_id).alias("snapshot_id"),
        F.count("*").alias("document_count"),
        F.count_if(status == "downloaded").alias("downloaded_count"),
        F.count_if(status == "skipped").alias("skipped_count"),
        F.count_if(status == "failed").alias("failed_count"),
        F.count_distinct("nct_id").alias("studies_with_documents"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_size_bytes"),
    )


def quality_metrics(expected: DataFrame, harmonized: DataFrame, features: DataFrame, embeddings: DataFrame | None = None) -> DataFrame:
    """The metrics row of a run: studies expected and processed, texts analysed, their means, embeddings made.

    ``features`` has ``token_count`` and ``lexical_diversity``; a text whose embedding failed counts as none.
    """
    made = F.lit(0).cast("bigint") if embeddings is None else embeddings.agg(F.count("embedding")).scalar()
    analysed = features.agg(
        F.count("*").alias("nlp_processed"),
        F.coalesce(F.avg("token_count"), F.lit(0.0)).alias("avg_token_count"),
        F.coalesce(F.avg("lexical_diversity"), F.lit(0.0)).alias("avg_lexical_diversity"),
    )
    count = lambda df: df.agg(F.count("*")).scalar()
    return analysed.withColumns(
        {"total_expected": count(expected), "total_processed": count(harmonized), "embeddings_generated": F.coalesce(made, F.lit(0).cast("bigint"))}
    )


def quality_gate(metrics: DataFrame, limits: QualityThresholds = QualityThresholds()) -> DataFrame:
    """Metrics row → the same with rates, ``passed`` and ``issues`` (metric, its value, its limit).

    Input: total_expected, total_processed, avg_token_count, avg_lexical_diversity, and any others, which stay
    (:func:`quality_metrics` makes the row). Too few studies
    or a high error rate fail; low tokens or diversity are only reported. The error rate may be
    negative.
    """
    expected, processed = F.col("total_expected"), F.col("total_processed")
    rated = metrics.withColumns(
        {
            "processing_rate": F.when(expected > 0, processed / expected * 100).otherwise(0.0),
            "error_rate": F.when(expected > 0, 1 - processed / expected).otherwise(1.0),
        }
    )
    few = processed < limits.min_studies_processed
    failing = F.col("error_rate") > limits.max_error_rate
    rules = (
        ("total_processed", few, limits.min_studies_processed),
        ("error_rate", failing, limits.max_error_rate),
        ("avg_token_count", F.col("avg_token_count") < limits.min_avg_tokens, limits.min_avg_tokens),
        ("avg_lexical_diversity", F.col("avg_lexical_diversity") < limits.min_lexical_diversity, limits.min_lexical_diversity),
    )
    issues = [
        F.when(
            broken,
            F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"), F.lit(float(limit)).alias("limit")),
        )
        for name, broken, limit in rules
    ]
    return rated.withColumns({"passed": ~few & ~failing, "issues": F.array_compact(F.array(*issues))})


def quality_results(judged: DataFrame, version_col: str, suite: str) -> DataFrame:
    """Gate outcomes as check results, one per (version, suite).

    A version that is judged more than once has failed if any judgement failed; the issues shown are
    the first in text order of those with that outcome.
    """
    shown = judged.select(
        F.col(version_col).alias("dataset_version_id"), F.coalesce("passed", F.lit(False)).alias("ok"), F.to_json("issues").alias("issues")
    )
    return shown.groupBy("dataset_version_id").agg(
        F.lit(suite).alias("check_suite"),
        F.when(F.bool_and("ok"), "passed").otherwise("failed").alias("gate_status"),
        F.coalesce(F.min(F.when(~F.col("ok"), F.col("issues"))), F.min("issues")).alias("issues"),
    )


# signal → (stay limit, pass limit); stay needs a smaller value, pass at least the limit
GATES = {
    "multi_hop_share": (0.15, 0.25),
    "path_latency_p95": (1.5, 2.5),
    "complex_queries": (10.0, 20.0),
    "blocked_features": (2.0, 4.0),
    "explainability_share": (0.20, 0.40),
    "retrieval_lift": (0.10, 0.20),
}


def weekly_latency(log: DataFrame, ts: str, latency: str) -> DataFrame:
    """Exact p95 per week; see :func:`trialspark.operators.ordered.exact_percentile`."""
    weeks = log.withColumn("week", F.date_trunc("week", ts).cast("date"))
    found = exact_percentile(weeks, latency, 0.95, "week")
    return found.select("week", F.col("percentile").alias("p95"), F.col("n").alias("queries"))


def workload_signals(log: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Multi-hop share, overall p95 of multi-hop reads, and runs of two slow weeks, as one row.

    ``log`` has ts, hops and latency_s; the window is the last ``days`` days up to ``as_of``.
    """
    end = F.lit(as_of).cast("timestamp_ntz")
    recent = log.filter((F.col("ts") <= end) & (F.col("ts") > end - F.expr(f"interval {days} days")))
    multi = recent.filter(F.col("hops") >= 4)
    weeks = weekly_latency(multi, "ts", "latency_s")
    slow = weeks.filter(F.col("p95") > GATES["path_latency_p95"][1]).select("week")
    following = slow.select(F.date_add("week", 7).alias("week"))
    runs = slow.join(following, "week", "left_semi").agg(F.count("*")).scalar()
    p95 = exact_percentile(multi, "latency_s", 0.95).agg(F.max("percentile")).scalar()
    return recent.agg(
        F.count("*").alias("reads"),
        (F.count_if(F.col("hops") >= 4) / F.count("*")).alias("multi_hop_share"),
    ).withColumns({"path_latency_p95": p95, "slow_week_runs": runs})


def decide_gates(signals: DataFrame, reported: Mapping[str, float]) -> DataFrame:
    """One row: which of the six gates pass, and ``go`` or ``no-go``.

    Measured signals come from :func:`workload_signals`, the other four are reported by their
    owners. Go needs four gates including latency (two slow weeks in a row) or blocked features.
    """
    value: dict[str, Column] = {"multi_hop_share": F.col("multi_hop_share")}
    value |= {name: F.lit(float(v)) for name, v in reported.items()}
    passed = {name: value[name] >= GATES[name][1] for name in GATES if name in value}
    passed["path_latency_p95"] = F.col("slow_week_runs") > 0
    flags = {f"{name}_pass": F.coalesce(passed.get(name, F.lit(False)), F.lit(False)) for name in GATES}
    decided = signals.withColumns(flags)
    total = sum((F.col(f).cast("int") for f in flags), F.lit(0))
    required = F.col("path_latency_p95_pass") | F.col("blocked_features_pass")
    return decided.withColumn("gates_passed", total).withColumn(
        "decision", F.when((F.col("gates_passed") >= 4) & required, "go").otherwise("no-go")
    )


def status_trend(trials: DataFrame) -> DataFrame:
    return (
        trials.groupBy("overall_status")
        .agg(F.count("*").alias("trials"))
        .orderBy(F.desc("trials"), "overall_status")
    )


def publications_by_journal(publications: DataFrame, limit: int = 20) -> DataFrame:
    return (
        publications.groupBy("journal")
        .agg(F.count("*").alias("publications"))
        .orderBy(F.desc("publications"), "journal")
        .limit(limit)
    )


def counts_by(df: DataFrame, category: str) -> DataFrame:
    return df.groupBy(category).agg(F.count("*").alias("n"))
