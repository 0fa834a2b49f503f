"""Column functions over text, lists, dates and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URL_PATTERN = r"https?://[^\s,]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column | str) -> Column:
    trimmed = strip(c)
    return F.when(trimmed != "", trimmed)


def pipe_list(c: Column | str, clean: bool = False) -> Column:
    """Split at ``|``; null gives an empty list. ``clean`` trims and drops empty parts."""
    parts = F.split(_col(c), "[|]")
    if clean:
        parts = F.filter(F.transform(parts, strip), lambda part: part != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def extract_urls(c: Column | str) -> Column:
    return F.coalesce(
        F.regexp_extract_all(_col(c), F.lit(URL_PATTERN), F.lit(0)), F.array().cast("array<string>")
    )


def parse_document(c: Column | str) -> Column:
    """``"Type, http…"`` → struct(document_type, url)."""
    c = _col(c)
    cut = F.instr(c, ", http")
    typed = F.struct(
        strip(F.substring(c, F.lit(1), cut - 1)).alias("document_type"),
        F.concat(F.lit("http"), strip(F.substring(c, cut + 6, F.length(c)))).alias("url"),
    )
    untyped = F.struct(F.lit("Unknown Document").alias("document_type"), strip(c).alias("url"))
    return F.when(cut > 0, typed).otherwise(untyped)


def url_filename(c: Column | str) -> Column:
    """Last path segment of a URL, without query, fragment and parameters."""
    path = F.regexp_extract(_col(c), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r";[^/]*$", ""), r"/+$", "")
    name = F.substring_index(path, "/", -1)
    return F.when(name != "", name).otherwise("unknown_document.pdf")


def safe_filename(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"(?U)[^\w\-.]", "_")


def file_extension(filename: Column | str, url: Column | str) -> Column:
    """Lower-case extension of the filename, else of the URL without its query; null if none."""
    filename, url = _col(filename), _col(url)
    of_url = F.substring_index(F.substring_index(url, ".", -1), "?", 1)
    return (
        F.when(
            F.coalesce(filename, F.lit("")) != "",
            F.when(F.contains(filename, F.lit(".")), F.lower(F.substring_index(filename, ".", -1))),
        )
        .when(F.contains(url, F.lit(".")), F.lower(of_url))
    )


def _first_date(c: Column, *formats: str) -> Column:
    return F.coalesce(*[F.try_to_date(c, fmt) for fmt in formats])


def parse_date3(c: Column | str) -> Column:
    """Pipeline dates: ``Month d, yyyy``, ISO, or US numeric; anything else is null."""
    return _first_date(_col(c), "MMMM d, yyyy", "yyyy-MM-dd", "M/d/yyyy")


def parse_date_flexible(c: Column | str) -> Column:
    """Record dates: five formats, and ``yyyy-MM`` read as the first of that month."""
    text = strip(c)
    month_only = (F.length(text) == 7) & (F.length(F.regexp_replace(text, "[^-]", "")) == 1)
    text = F.when(month_only, F.concat(text, F.lit("-01"))).otherwise(text)
    return _first_date(text, "yyyy-M-d", "MMMM d, yyyy", "M/d/yyyy", "d-MMM-yyyy", "yyyy/M/d")


def partial_date(c: Column | str) -> Column:
    """``yyyy``, ``yyyy-MM`` or ``yyyy-MM-dd`` → struct(value, precision); null otherwise."""
    c = _col(c)

    def part(suffix: str, precision: str) -> Column:
        value = F.try_to_date(F.concat(c, F.lit(suffix)), "yyyy-MM-dd")
        return F.when(
            value.isNotNull(), F.struct(value.alias("value"), F.lit(precision).alias("precision"))
        )

    return (
        F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), part("", "day"))
        .when(c.rlike(r"^\d{4}-\d{2}$"), part("-01", "month"))
        .when(c.rlike(r"^\d{4}$"), part("-01-01", "year"))
    )


def yes_flag(c: Column | str) -> Column:
    return F.lower(_col(c)).isin("yes", "true", "1")


def try_int(c: Column | str) -> Column:
    """Whole numbers only; text that is not one becomes null."""
    c = _col(c)
    return F.when(c.rlike(r"^[+-]?\d+$"), c.try_cast("bigint"))


def age_years(c: Column | str) -> Column:
    """``"16 years"``, ``"28 Days"`` → years as a double, so that ages compare."""
    c = F.lower(strip(c))
    number = F.regexp_extract(c, r"^(\d+(?:\.\d+)?)\s*(?:year|month|week|day|hour|minute)s?$", 1)
    unit = F.regexp_extract(c, r"(year|month|week|day|hour|minute)s?$", 1)
    per_year = (
        F.when(unit == "year", 1.0)
        .when(unit == "month", 12.0)
        .when(unit == "week", 365.25 / 7)
        .when(unit == "day", 365.25)
        .when(unit == "hour", 365.25 * 24)
        .when(unit == "minute", 365.25 * 24 * 60)
    )
    return number.try_cast("double") / per_year


def shard_hash(c: Column | str) -> Column:
    """Non-negative 32-bit number from the md5 of the key; the same in every engine."""
    return F.conv(F.substring(F.md5(_col(c)), 1, 8), 16, 10).cast("bigint")


def size_diff_pct(a: Column | str, b: Column | str) -> Column:
    a, b = _col(a), _col(b)
    larger = F.greatest(a, b)
    return F.when(larger > 0, F.round(F.abs(a - b) / larger * 100, 2))


def attribute(c: Column | str, path: str, type_name: str) -> Column:
    """A typed field of a JSON text column; null when absent or of another type."""
    return F.try_variant_get(F.try_parse_json(_col(c)), path, type_name)


def year_and_length(date: Column | str, text: Column | str) -> Column:
    return F.struct(F.year(_col(date)).alias("year"), F.char_length(_col(text)).alias("text_length"))
