"""Nested study records: parsing, flattening, and the canonical tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark import schemas
from trialspark.functions.scalars import parse_date_flexible

_PROTOCOL = "study.protocolSection."


def parse_studies(df: DataFrame, json_col: str = "study_json") -> DataFrame:
    """Add the typed ``study`` struct and ``corrupt_record`` (null for readable text)."""
    parsed = F.from_json(
        json_col,
        schemas.STUDY_DDL + ", corrupt_record string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt_record"},
    )
    # A generator keeps the parse in one place: as a plain column the optimizer would copy it into
    # every filter and projection that reads a field of it, and parse again for each.
    once = df.select("*", F.inline(F.array(F.struct(parsed.alias("study")))))
    unreadable = F.when(F.col("study").isNull(), F.col(json_col)).otherwise(F.col("study.corrupt_record"))
    return once.withColumn("corrupt_record", unreadable)


def normalize_phases(phases: Column | str) -> Column:
    """Known phase names and spellings; anything else is ``NA``; null gives an empty list."""
    phases = F.col(phases) if isinstance(phases, str) else phases

    def one(phase: Column) -> Column:
        name = F.replace(F.upper(phase), F.lit(" "), F.lit("_"))
        alias = F.create_map(*[F.lit(x) for pair in schemas.PHASE_ALIASES.items() for x in pair])
        return (
            F.when(name.isin(*schemas.STUDY_PHASES), name)
            .when(name.isin(*schemas.PHASE_ALIASES), F.element_at(alias, name))
            .otherwise("NA")
        )

    return F.coalesce(F.transform(phases, one), F.array().cast("array<string>"))


def _list(path: str, field: str | None = None) -> Column:
    """A list at a path, empty when any part is missing; nameless items are dropped."""
    items = F.col(path)
    if field is not None:
        items = F.filter(F.transform(items, lambda x: x[field]), lambda v: v.isNotNull() & (v != ""))
    return F.coalesce(items, F.array().cast("array<string>"))


def flatten_studies(df: DataFrame, key: str = "nct_id") -> DataFrame:
    """One row of 21 columns per study; the key is the record's file stem, not its content."""
    at = lambda path: F.col(_PROTOCOL + path)
    return df.select(
        F.col(key).alias("json_nct_id"),
        at("identificationModule.officialTitle").alias("json_official_title"),
        at("identificationModule.briefTitle").alias("json_brief_title"),
        at("identificationModule.acronym").alias("json_acronym"),
        at("statusModule.overallStatus").alias("json_overall_status"),
        at("designModule.studyType").alias("json_study_type"),
        normalize_phases(_PROTOCOL + "designModule.phases").alias("json_phases"),
        F.coalesce("study.hasResults", F.lit(False)).alias("json_has_results"),
        at("descriptionModule.briefSummary").alias("json_brief_summary"),
        at("descriptionModule.detailedDescription").alias("json_detailed_description"),
        _list(_PROTOCOL + "conditionsModule.conditions").alias("json_conditions"),
        _list(_PROTOCOL + "armsInterventionsModule.interventions", "name").alias("json_interventions"),
        _list("study.derivedSection.conditionBrowseModule.meshes", "term").alias("json_condition_meshes"),
        at("eligibilityModule.sex").alias("json_sex"),
        at("eligibilityModule.minimumAge").alias("json_minimum_age"),
        at("eligibilityModule.maximumAge").alias("json_maximum_age"),
        at("eligibilityModule.healthyVolunteers").alias("json_healthy_volunteers"),
        at("designModule.enrollmentInfo.count").alias("json_enrollment"),
        at("statusModule.startDateStruct.date").alias("json_start_date"),
        at("statusModule.completionDateStruct.date").alias("json_completion_date"),
        _list("study.documentSection.largeDocumentModule.largeDocs", "filename").alias("json_document_files"),
    )


def surrogate_key(*parts: Column | str) -> Column:
    """Stable 64-bit key from the natural key, in place of a sequence."""
    return F.xxhash64(*parts)


PROVENANCE = ("source_snapshot_id", "source_system", "source_record_id", "source_content_sha256")


def _canonical_rows(df: DataFrame, snapshot_id: str, system: str) -> tuple[DataFrame, dict[str, Column]]:
    """Studies with keys and provenance, and for each table the array of rows that a study has in it."""
    base = df.select(
        F.col("nct_id"),
        surrogate_key("nct_id").alias("trial_id"),
        F.col("study"),
        F.lit(snapshot_id).alias("source_snapshot_id"),
        F.lit(system).alias("source_system"),
        F.col("nct_id").alias("source_record_id"),
        F.sha2("study_json", 256).alias("source_content_sha256"),
    )
    at = lambda path: F.col(_PROTOCOL + path)
    date_at = lambda path: parse_date_flexible(_PROTOCOL + path)
    sponsor_name = at("sponsorCollaboratorsModule.leadSponsor.name")

    def children(items: Column, name: str, columns: dict[str, Callable[[Column], Column]], required: str | None) -> Column:
        def row(item: Column, place: Column) -> Column:
            own = [make(item).alias(n) for n, make in columns.items()]
            return F.struct(surrogate_key(F.lit(name), F.col("trial_id"), place).alias(f"{name}_id"), "trial_id", *own, *PROVENANCE)

        rows = F.transform(items, row)
        return rows if required is None else F.filter(rows, lambda r: r[required].isNotNull())

    def field(path: str) -> Callable[[Column], Column]:
        parts = path.split(".")
        return lambda item: reduce(lambda c, p: c[p], parts, item)

    def outcomes(kind: str, path: str) -> Column:
        made = F.transform(
            at("outcomesModule." + path),
            lambda o: F.struct(F.lit(kind).alias("kind"), o["measure"].alias("measure"), o["timeFrame"].alias("timeFrame")),
        )
        return F.coalesce(made, F.array().cast("array<struct<kind:string,measure:string,timeFrame:string>>"))

    trial = F.struct(
        "trial_id",
        "nct_id",
        F.when(sponsor_name.isNotNull(), surrogate_key(sponsor_name)).alias("sponsor_id"),
        at("identificationModule.officialTitle").alias("official_title"),
        at("identificationModule.briefTitle").alias("brief_title"),
        at("statusModule.overallStatus").alias("overall_status"),
        at("designModule.studyType").alias("study_type"),
        F.get(normalize_phases(_PROTOCOL + "designModule.phases"), F.lit(0)).alias("phase"),
        at("designModule.enrollmentInfo.count").cast("int").alias("enrollment"),
        date_at("statusModule.studyFirstPostDateStruct.date").alias("first_posted"),
        date_at("statusModule.lastUpdatePostDateStruct.date").alias("last_update_posted"),
        *PROVENANCE,
    )
    sponsor = F.struct(
        surrogate_key(sponsor_name).alias("sponsor_id"), sponsor_name.alias("sponsor_name"),
        at("sponsorCollaboratorsModule.leadSponsor.class").alias("sponsor_type"), *PROVENANCE,
    )
    rows = {
        "trial": F.array(trial),
        "sponsor": F.filter(F.array(sponsor), lambda r: r["sponsor_name"].isNotNull()),
        "condition": children(at("conditionsModule.conditions"), "condition", {"condition_name": lambda x: x}, "condition_name"),
        "intervention": children(
            at("armsInterventionsModule.interventions"), "intervention",
            {"intervention_type": field("type"), "intervention_name": field("name")}, "intervention_name",
        ),
        "arm": children(
            at("armsInterventionsModule.armGroups"), "arm",
            {"arm_label": field("label"), "arm_type": field("type"), "description": field("description")}, "arm_label",
        ),
        "endpoint": children(
            F.concat(outcomes("primary", "primaryOutcomes"), outcomes("secondary", "secondaryOutcomes"), outcomes("other", "otherOutcomes")),
            "endpoint",
            {"endpoint_type": field("kind"), "endpoint_name": field("measure"), "endpoint_timeframe": field("timeFrame")}, "endpoint_name",
        ),
        "site": children(
            at("contactsLocationsModule.locations"), "site",
            {
                "facility_name": field("facility"), "city": field("city"), "state": field("state"), "country": field("country"),
                "postal_code": field("zip"), "latitude": field("geoPoint.lat"), "longitude": field("geoPoint.lon"),
            },
            None,
        ),
        "publication": children(
            at("referencesModule.references"), "publication", {"pmid": field("pmid"), "title": field("citation")}, None
        ),
    }
    return base, rows


def _one_per_sponsor(rows: DataFrame) -> DataFrame:
    """A sponsor of many trials is merged map-side; its type and provenance are the smallest record's."""
    rest = ["sponsor_type", *PROVENANCE]
    return rows.groupBy("sponsor_id", "sponsor_name").agg(*[F.min_by(c, "source_record_id").alias(c) for c in rest])


def load_canonical(df: DataFrame, snapshot_id: str, system: str = "registry_json") -> dict[str, DataFrame]:
    """Canonical tables from parsed studies (columns ``nct_id``, ``study_json``, ``study``), each a plan of its own.

    Every table is one projection of the input: loading needs no join, because child rows carry the
    trial key computed from the study id. To load all of them use :func:`write_canonical`.
    """
    base, rows = _canonical_rows(df, snapshot_id, system)
    tables = {name: base.select(F.inline(items)) for name, items in rows.items()}
    return tables | {"sponsor": _one_per_sponsor(tables["sponsor"])}


def write_canonical(df: DataFrame, path: str, snapshot_id: str, system: str = "registry_json") -> dict[str, DataFrame]:
    """The canonical tables, written in one pass: each study is parsed once and its rows fan out by table.

    A row carries the name of its table and that table's columns; the write deals rows to a folder per
    table, and each table reads its own columns back. No row is shuffled: each task writes one file per table
    and sorts its rows by table for that, so the partitions of ``df`` should be some ten thousand studies.
    Returns the tables.
    """
    base, rows = _canonical_rows(df, snapshot_id, system)
    kinds = {name: base.select(items.alias("r")).schema["r"].dataType.elementType for name, items in rows.items()}

    def tagged(name: str, items: Column) -> Column:
        def tag(row: Column) -> Column:
            own = [(row if other == name else F.lit(None).cast(kind)).alias(other) for other, kind in kinds.items()]
            return F.struct(F.lit(name).alias("table_name"), *own)

        return F.coalesce(F.transform(items, tag), F.array())

    all_rows = base.select(F.inline(F.concat(*[tagged(name, items) for name, items in rows.items()])))
    all_rows.write.mode("overwrite").option("compression", "zstd").partitionBy("table_name").parquet(path)
    spark = df.sparkSession
    whole = spark.read.schema(all_rows.schema).parquet(path)
    tables = {name: whole.filter(F.col("table_name") == name).select(f"{name}.*") for name in rows}
    return tables | {"sponsor": _one_per_sponsor(tables["sponsor"])}
