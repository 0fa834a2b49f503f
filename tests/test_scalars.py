import datetime

import pytest
from pyspark.sql import functions as F

from trialspark.functions import geo, scalars, text, vectors
from trialspark.operators.flatten import normalize_phases


def value(spark, column, **inputs):
    rows = [tuple(inputs.values())] if inputs else [("x",)]
    schema = ", ".join(f"{k} string" for k in inputs) or "x string"
    return spark.createDataFrame(rows, schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "given, pipeline, record",
    [
        ("March 5, 2012", "2012-03-05", "2012-03-05"),
        ("2012-04-15", "2012-04-15", "2012-04-15"),
        ("4/5/2012", "2012-04-05", "2012-04-05"),
        ("04/05/2012", "2012-04-05", "2012-04-05"),
        ("2012-04", None, "2012-04-01"),
        ("15-Jan-2020", None, "2020-01-15"),
        ("2020/01/15", None, "2020-01-15"),
        ("2012-02-30", None, None),
        ("soon", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_dates(spark, given, pipeline, record):
    iso = lambda d: d and d.isoformat()
    assert iso(value(spark, scalars.parse_date3("c"), c=given)) == pipeline
    assert iso(value(spark, scalars.parse_date_flexible("c"), c=given)) == record


@pytest.mark.parametrize(
    "given, expected",
    [
        ("2012", (datetime.date(2012, 1, 1), "year")),
        ("2012-04", (datetime.date(2012, 4, 1), "month")),
        ("2012-04-15", (datetime.date(2012, 4, 15), "day")),
        ("2012-13", None),
        ("12", None),
    ],
)
def test_partial_dates(spark, given, expected):
    got = value(spark, scalars.partial_date("c"), c=given)
    assert (tuple(got) if got else None) == expected


@pytest.mark.parametrize(
    "given, raw, clean",
    [
        ("a|b", ["a", "b"], ["a", "b"]),
        (" a || b ", [" a ", "", " b "], ["a", "b"]),
        ("", [""], []),
        (None, [], []),
    ],
)
def test_pipe_lists(spark, given, raw, clean):
    assert value(spark, scalars.pipe_list("c"), c=given) == raw
    assert value(spark, scalars.pipe_list("c", clean=True), c=given) == clean


@pytest.mark.parametrize(
    "given, kind, url, name",
    [
        ("Protocol, https://x.org/a/p_v1.pdf", "Protocol", "https://x.org/a/p_v1.pdf", "p_v1.pdf"),
        ("Plan, v2, http://x.org/plan.doc?y=1#z", "Plan, v2", "http://x.org/plan.doc?y=1#z", "plan.doc"),
        (" https://x.org/dir/ ", "Unknown Document", "https://x.org/dir/", "dir"),
        ("https://x.org", "Unknown Document", "https://x.org", "unknown_document.pdf"),
        ("https://x.org/?q=a.pdf", "Unknown Document", "https://x.org/?q=a.pdf", "unknown_document.pdf"),
    ],
)
def test_documents(spark, given, kind, url, name):
    got = value(spark, scalars.parse_document("c"), c=given)
    assert tuple(got) == (kind, url)
    assert value(spark, scalars.url_filename("c"), c=url) == name


def test_names_and_extensions(spark):
    assert value(spark, scalars.safe_filename("c"), c="Prüf plan (v1).pdf") == "Prüf_plan__v1_.pdf"
    extension = scalars.file_extension("f", "u")
    assert value(spark, extension, f="A.PDF", u=None) == "pdf"
    assert value(spark, extension, f="noext", u="http://x/y.doc") is None
    assert value(spark, extension, f="", u="http://x/y.Doc?a=1") == "doc"


@pytest.mark.parametrize("given, expected", [("YES", True), ("true", True), ("1", True), ("no", False), (None, None)])
def test_flags(spark, given, expected):
    assert value(spark, scalars.yes_flag("c"), c=given) is expected


@pytest.mark.parametrize("given, expected", [("12", 12), ("-3", -3), ("12.5", None), ("n/a", None), ("9" * 30, None)])
def test_integers(spark, given, expected):
    assert value(spark, scalars.try_int("c"), c=given) == expected


@pytest.mark.parametrize("given, years", [("16 years", 16), ("28 Days", 28 / 365.25), ("6 Months", 0.5), ("N/A", None)])
def test_ages(spark, given, years):
    got = value(spark, scalars.age_years("c"), c=given)
    assert got == years if years is None else got == pytest.approx(years)


def test_phases(spark):
    phases = spark.createDataFrame([(["PHASE1", "phase 3", "Early Phase 1", "n/a", "odd", None],), (None,)], "p array<string>")
    got = [r[0] for r in phases.select(normalize_phases("p")).collect()]
    assert got == [["PHASE_1", "PHASE_3", "EARLY_PHASE_1", "NA", "NA", "NA"], []]


def test_vectors(spark):
    rows = [([1.0, 0.0], 1.0), ([0.0, 2.0], 0.0), ([3.0, 4.0], 0.6), ([1.0], 0.0), ([0.0, 0.0], 0.0), ([], 0.0), (None, 0.0)]
    df = spark.createDataFrame(rows, "v array<double>, expected double")
    for row in df.select("expected", vectors.cosine([1.0, 0.0], "v").alias("got")).collect():
        assert row.got == pytest.approx(row.expected)


def test_lexical_overlap_counts_repeats(spark):
    score = text.lexical_overlap("EGFR egfr positive", "c")
    assert value(spark, score, c="egfr-mutant tumour") == pytest.approx(2 / 3)
    assert value(spark, score, c="egfrx") == 0
    assert value(spark, score, c=None) == 0
    assert value(spark, text.lexical_overlap("--", "c"), c="anything") == 0


def test_decay(spark):
    km = F.lit(110.0)
    for func in ("exp", "gauss", "linear"):
        assert value(spark, geo.distance_decay(km, func, 100.0, 10.0, 0.3)) == pytest.approx(0.3)
    assert value(spark, geo.distance_decay(F.lit(5.0), "exp", 100.0, 10.0)) == 1
