"""Harmonization of the wide CSV and the flattened JSON studies into one table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark import schemas
from trialspark.functions.scalars import parse_date3, pipe_list, shard_hash, try_int, yes_flag

STRATEGIES = ("json_priority", "csv_priority", "merge_all")

# output column → (JSON column, CSV column)
_COALESCED = {
    "official_title": ("json_official_title", "title"),
    "brief_title": ("json_brief_title", "title"),
    "overall_status": ("json_overall_status", "overall_status"),
    "study_type": ("json_study_type", "study_type"),
    "brief_summary": ("json_brief_summary", "brief_summary"),
    "conditions": ("json_conditions", "conditions"),
    "interventions": ("json_interventions", "interventions"),
    "sex": ("json_sex", "sex"),
    "enrollment": ("json_enrollment", "enrollment"),
}
_JSON_ONLY = {
    "detailed_description": "json_detailed_description",
    "condition_meshes": "json_condition_meshes",
    "has_results": "json_has_results",
}
_MERGED_LISTS = ("conditions", "interventions")
_PRESERVED = {
    "csv_title": "title",
    "json_official_title_preserved": "json_official_title",
    "json_brief_title_preserved": "json_brief_title",
    "csv_overall_status": "overall_status",
    "csv_sex": "sex",
    "csv_enrollment": "enrollment",
}
_UNMAPPED = {
    "maximum_age": "json_maximum_age",
    "healthy_volunteers": "json_healthy_volunteers",
    "document_files": "json_document_files",
}


def rename_csv_headers(df: DataFrame) -> DataFrame:
    present = {k: v for k, v in schemas.CSV_TO_HARMONIZED.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def standardize_csv(df: DataFrame) -> DataFrame:
    """Harmonized names and types for the columns that are present, in one projection."""
    df = rename_csv_headers(df)
    typed = {c: pipe_list(c) for c in schemas.CSV_LIST_COLUMNS if c in df.columns}
    typed |= {c: parse_date3(c) for c in schemas.CSV_DATE_COLUMNS if c in df.columns}
    if "has_results" in df.columns:
        typed["has_results"] = yes_flag("has_results")
    if "enrollment" in df.columns:
        typed["enrollment"] = try_int("enrollment")
    return df.withColumns(typed)


def _with_missing(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns})


def join_sources(csv: DataFrame, flat: DataFrame) -> DataFrame:
    """Full outer join on the study id with one coalesced key.

    Rows without an id match nothing. They get a join key from their own content, so that a large
    share of them spreads over the shuffle instead of meeting in the null partition.
    """
    csv = _with_missing(csv, {c: t for c, t in schemas.HARMONIZED_TYPES.items() if c != "data_source"})
    spread = lambda side, key, df: F.coalesce(
        F.col(key), F.concat(F.lit(f"\u0000{side}"), F.xxhash64(*df.columns).cast("string"))
    )
    left = csv.withColumn("_key", spread("csv", "nct_id", csv))
    right = flat.withColumn("_key", spread("json", "json_nct_id", flat))
    joined = left.join(right, "_key", "full").drop("_key")
    return joined.withColumn("nct_id", F.coalesce("nct_id", "json_nct_id")).drop("json_nct_id")


def _source_label(strategy: str) -> Column:
    in_json = F.col("json_official_title").isNotNull()
    in_csv = F.col("title").isNotNull()
    if strategy == "json_priority":
        return F.when(in_json, "json_priority").otherwise("csv_only")
    if strategy == "csv_priority":
        return F.when(in_csv, "csv_priority").otherwise("json_only")
    return F.when(in_json & in_csv, "merged").when(in_json, "json_only").otherwise("csv_only")


def coalesce_sources(
    joined: DataFrame,
    strategy: str = "json_priority",
    *,
    empty_as_null: bool = False,
    results_from_csv: bool = False,
    fill_unmapped: bool = False,
) -> DataFrame:
    """Apply one strategy and label ``data_source``; every expression sees the input columns.

    Only null counts as missing, so an empty JSON list wins over a filled CSV list unless
    ``empty_as_null``. ``has_results`` comes from JSON alone unless ``results_from_csv``. JSON ages,
    volunteer flag and document files stay null unless ``fill_unmapped``.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")

    def value(name: str) -> Column:
        if empty_as_null and name in dict(joined.dtypes) and dict(joined.dtypes)[name].startswith("array"):
            return F.when(F.size(name) > 0, F.col(name))
        return F.col(name)

    out: dict[str, Column] = {}
    for target, (from_json, from_csv) in _COALESCED.items():
        pair = (value(from_json), value(from_csv))
        if strategy == "csv_priority":
            pair = pair[::-1]
        out[target] = F.coalesce(*pair)
        if strategy == "merge_all" and target in _MERGED_LISTS:
            both = pair[0].isNotNull() & pair[1].isNotNull()
            union = F.array_sort(F.array_distinct(F.concat(*pair)))
            out[target] = F.when(both, union).otherwise(out[target])
    for target, source in _JSON_ONLY.items():
        out[target] = F.col(source)
    if results_from_csv:
        out["has_results"] = F.coalesce("json_has_results", "has_results")
    if fill_unmapped:
        for target, source in _UNMAPPED.items():
            out[target] = F.coalesce(F.col(source), F.col(target))
    if strategy == "merge_all":
        out |= {target: F.col(source) for target, source in _PRESERVED.items()}
    out["data_source"] = _source_label(strategy)
    return joined.withColumns(out)


def enforce_schema(df: DataFrame) -> DataFrame:
    """The output columns in order: cast when present, typed null when missing."""
    return df.select(
        *[
            (F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c)
            for c, t in schemas.HARMONIZED_TYPES.items()
        ]
    )


def finalize(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Shard hash and one processing timestamp for the whole run, then the enforced schema."""
    run_ts = run_ts or datetime.now(timezone.utc)
    stamped = df.withColumns(
        {"shard_hash": shard_hash("nct_id"), "processing_timestamp": F.lit(run_ts).cast("timestamp")}
    )
    return enforce_schema(stamped)


def harmonize(
    csv: DataFrame,
    flat: DataFrame,
    strategy: str = "json_priority",
    run_ts: datetime | None = None,
    **options: bool,
) -> DataFrame:
    """Raw CSV rows and flattened JSON studies → the enforced harmonized table."""
    joined = join_sources(standardize_csv(csv), flat)
    coalesced = joined.transform(coalesce_sources, strategy, **options)
    return finalize(coalesced, run_ts)


def with_derived_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "document_count": F.coalesce(F.array_size("document_urls"), F.lit(0))
            + F.coalesce(F.array_size("document_files"), F.lit(0)),
            "has_json_data": F.col("data_source").isin("json_priority", "csv_fallback"),
            "is_interventional": F.coalesce(F.col("study_type") == "INTERVENTIONAL", F.lit(False)),
            "is_recruiting": F.coalesce(
                F.col("overall_status").isin(*schemas.RECRUITING_STATUSES), F.lit(False)
            ),
        }
    )


def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of both sides with presence flags: one aggregation, no join."""
    flagged = a.select(key, F.lit(True).alias("in_a"), F.lit(False).alias("in_b")).unionByName(
        b.select(key, F.lit(False).alias("in_a"), F.lit(True).alias("in_b"))
    )
    return flagged.groupBy(key).agg(F.bool_or("in_a").alias("in_a"), F.bool_or("in_b").alias("in_b"))


def overlap_statistics(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    both = F.col("in_a") & F.col("in_b")
    counts = key_overlap(a, b, key).agg(
        F.count_if("in_a").alias("csv_total"),
        F.count_if("in_b").alias("json_total"),
        F.count_if(both).alias("overlap_count"),
        F.count_if(F.col("in_a") & ~F.col("in_b")).alias("csv_only_count"),
        F.count_if(F.col("in_b") & ~F.col("in_a")).alias("json_only_count"),
    )
    share = F.when(F.col("csv_total") > 0, F.col("overlap_count") / F.col("csv_total") * 100).otherwise(0.0)
    return counts.withColumn("overlap_percentage", share)


def harmonization_statistics(csv: DataFrame, flat: DataFrame, harmonized: DataFrame) -> DataFrame:
    """Overlap counts with output size, coverage and studies that have document URLs."""
    keys = csv.select(F.col("nct_id").alias("key"))
    other = flat.select(F.col("json_nct_id").alias("key"))
    counts = overlap_statistics(keys, other, "key")
    produced = harmonized.agg(
        F.struct(
            F.count("*").alias("harmonized_count"),
            F.count_if(F.size(F.coalesce("document_urls", F.array().cast("array<string>"))) > 0).alias(
                "document_url_count"
            ),
        )
    ).scalar()
    coverage = F.when(F.col("csv_total") > 0, F.col("json_total") / F.col("csv_total") * 100).otherwise(0.0)
    return counts.withColumn("_p", produced).select(
        F.col("csv_total").alias("csv_study_count"),
        F.col("json_total").alias("json_study_count"),
        "overlap_count",
        "csv_only_count",
        "json_only_count",
        "_p.harmonized_count",
        "_p.document_url_count",
        "overlap_percentage",
        coverage.alias("json_coverage_percentage"),
    )
