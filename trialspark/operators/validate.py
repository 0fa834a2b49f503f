"""Rules over tables: each returns the violations instead of stopping at the first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialspark import schemas
from trialspark.functions.scalars import blank_to_null, parse_date_flexible


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Trim every string column; blank becomes null."""
    return df.select(
        *[blank_to_null(f"`{c}`").alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes]
    )


def _one_of(c: str, allowed: tuple[str, ...]) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).isin(*allowed)


_CSV_ENUMS = {
    "overall_status": schemas.STUDY_STATUSES,
    "has_results": schemas.RESULT_FLAGS,
    "study_type": schemas.STUDY_TYPES,
    "sex": schemas.SEXES,
    "study_phase": schemas.STUDY_PHASES,
}


def validate_csv(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw text rows under harmonized names → (valid, quarantined with an ``errors`` list).

    Ids are upper-cased. A date that cannot be read is null, not an error.
    """
    df = blanks_to_null(df).withColumn("nct_id", F.upper("nct_id"))
    dates = {c: parse_date_flexible(c) for c in schemas.CSV_DATE_COLUMNS if c in df.columns}
    df = df.withColumns(dates)
    rules = {
        "nct_id: missing": F.col("nct_id").isNull(),
        "nct_id: must start with NCT": ~F.startswith(F.col("nct_id"), F.lit("NCT")),
    }
    rules |= {f"{c}: not allowed": _one_of(c, allowed) for c, allowed in _CSV_ENUMS.items() if c in df.columns}
    if "enrollment" in df.columns:
        whole = F.col("enrollment").rlike(r"^[+-]?\d+(\.0+)?$")
        rules["enrollment: not an integer"] = F.col("enrollment").isNotNull() & ~whole
    return split_by_rules(df, rules)


def validate_studies(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed studies → (valid, quarantined): readable JSON, required id, enumerated fields."""
    module = "study.protocolSection.identificationModule"
    enums = {
        "overallStatus": ("study.protocolSection.statusModule.overallStatus", schemas.STUDY_STATUSES),
        "studyType": ("study.protocolSection.designModule.studyType", schemas.STUDY_TYPES),
        "sex": ("study.protocolSection.eligibilityModule.sex", schemas.SEXES),
    }
    rules = {
        "record: unreadable": F.col("corrupt_record").isNotNull(),
        "nctId: missing": F.col(module).isNotNull() & F.col(module + ".nctId").isNull(),
    }
    rules |= {f"{name}: not allowed": _one_of(path, allowed) for name, (path, allowed) in enums.items()}
    return split_by_rules(df, rules)


def split_by_rules(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    errors = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    checked = df.withColumn("errors", errors)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def error_counts(quarantined: DataFrame) -> DataFrame:
    return quarantined.select(F.explode("errors").alias("error")).groupBy("error").agg(
        F.count("*").alias("rows_failed")
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once. Rows with a null key part never conflict."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        df.filter(present).groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)
    )


def check_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule with the number of rows that break it; null counts as kept."""
    counted = df.agg(*[F.count_if(~holds).alias(name) for name, holds in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.filter(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def referential_breaks(
    tables: dict[str, DataFrame], foreign_keys: list[tuple[str, str, str, str]]
) -> DataFrame:
    """Orphan counts per (child, child key, parent, parent key).

    Whether any key is lost is asked of the child's distinct keys, in one job for all keys; an extract without
    breaks never moves its rows. Rows are counted only for the foreign keys that are broken.
    """
    lost, found = {}, []
    for child, child_key, parent, parent_key in foreign_keys:
        name = f"{child}.{child_key} -> {parent}.{parent_key}"
        keys = orphans(tables[child].select(child_key).distinct(), tables[parent], child_key, parent_key)
        lost[name] = (child, child_key, keys)
        found.append(keys.agg(F.count("*").alias("n")).select(F.lit(name).alias("foreign_key"), "n"))
    broken = {r.foreign_key for r in reduce(DataFrame.unionByName, found).filter("n > 0").collect()}
    counts = []
    for name, (child, child_key, keys) in lost.items():
        rows = tables[child].join(keys, child_key, "left_semi") if name in broken else keys.sparkSession.range(0)
        counts.append(rows.agg(F.count("*").alias("orphans")).select(F.lit(name).alias("foreign_key"), "orphans"))
    return reduce(DataFrame.unionByName, counts)
