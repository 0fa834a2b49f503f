"""Study search as DataFrame predicates: filters, relevance, projection, sorting and paging."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialspark.functions.geo import KM_PER_MILE, bounding_box, distance_decay, haversine_km
from trialspark.functions.text import contains_token, query_tokens

MAX_PAGE = 1000


def length_km(text: str) -> float:
    """``"50km"``, ``"50mi"`` or a bare number (miles, as in the registry's own service)."""
    match = re.fullmatch(r"(\d+(?:\.\d+)?)(km|mi)?", text)
    if match is None:
        raise ValueError(f"not a distance: {text}")
    return float(match[1]) * (1.0 if match[2] == "km" else KM_PER_MILE)


def parse_geo(text: str) -> tuple[float, float, float]:
    """``distance(lat,lon,r[km|mi])`` → (lat, lon, km)."""
    match = re.fullmatch(r"distance\((-?\d+(?:\.\d+)?),(-?\d+(?:\.\d+)?),(\d+(?:\.\d+)?(?:km|mi)?)\)", text)
    if match is None:
        raise ValueError(f"not a geo filter: {text}")
    return float(match[1]), float(match[2]), length_km(match[3])


def parse_decay(text: str) -> dict:
    """``func:exp,scale:300mi,offset:0mi,decay:0.5`` → arguments of ``distance_decay``."""
    parts = dict(p.split(":", 1) for p in text.split(","))
    return {
        "func": parts["func"],
        "scale_km": length_km(parts["scale"]),
        "offset_km": length_km(parts["offset"]),
        "decay": float(parts["decay"]),
    }


def filter_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in another table: a semi join, whatever the size of the set."""
    return df.join(ids.select(key), key, "left_semi")


def in_range(c: str, low=None, high=None) -> Column:
    """Closed range with open ends; null is outside."""
    kept = F.col(c).isNotNull()
    if low is not None:
        kept = kept & (F.col(c) >= F.lit(low))
    if high is not None:
        kept = kept & (F.col(c) <= F.lit(high))
    return kept


def filter_studies(
    df: DataFrame,
    *,
    statuses: Sequence[str] | None = None,
    ids: Sequence[str] | None = None,
    ranges: Mapping[str, tuple] | None = None,
    geo: str | None = None,
    sites: DataFrame | None = None,
) -> DataFrame:
    """Status list, id list, field ranges and distance to any site of the study."""
    if statuses:
        df = df.filter(F.col("overall_status").isin(*statuses))
    if ids:
        df = df.filter(F.col("nct_id").isin(*[i.upper() for i in ids]))
    for name, (low, high) in (ranges or {}).items():
        df = df.filter(in_range(name, low, high))
    if geo is not None:
        df = df.join(sites_in(sites, geo).select("trial_id"), "trial_id", "left_semi")
    return df


def sites_in(sites: DataFrame, geo: str) -> DataFrame:
    lat, lon, km = parse_geo(geo)
    return (
        sites.filter(bounding_box(lat, lon, km, "latitude", "longitude"))
        .withColumn("distance_km", haversine_km("latitude", "longitude", lat, lon))
        .filter(F.col("distance_km") <= km)
    )


def geo_decay(sites: DataFrame, geo: str, decay: str) -> DataFrame:
    """(trial, distance to its closest site in the area, proximity factor)."""
    closest = sites_in(sites, geo).groupBy("trial_id").agg(F.min("distance_km").alias("distance_km"))
    return closest.withColumn("proximity", distance_decay(F.col("distance_km"), **parse_decay(decay)))


def search_area(df: DataFrame, query: str, weights: Mapping[str, float]) -> DataFrame:
    """Rows where every query token occurs in some column of the area, with ``relevance``.

    Relevance is the sum, over columns, of the column's weight times the share of tokens in it.
    """
    wanted = sorted(set(query_tokens(query)))
    if not wanted:
        return df.withColumn("relevance", F.lit(0.0))
    found = {c: [contains_token(c, t) for t in wanted] for c in weights}
    everywhere = reduce(
        lambda a, b: a & b,
        [reduce(lambda a, b: a | b, [found[c][i] for c in weights]) for i in range(len(wanted))],
    )
    relevance = reduce(
        lambda a, b: a + b,
        [
            F.lit(float(w)) * reduce(lambda a, b: a + b, [h.cast("int") for h in found[c]]) / len(wanted)
            for c, w in weights.items()
        ],
    )
    return df.filter(everywhere).withColumn("relevance", relevance)


# option keys of the aggregation filters and the values they stand for
AGG_OPTIONS = {
    "results": ("has_results", {"with": [True], "without": [False]}),
    "status": (
        "overall_status",
        {
            "not": ["NOT_YET_RECRUITING"],
            "rec": ["RECRUITING"],
            "act": ["ACTIVE_NOT_RECRUITING"],
            "com": ["COMPLETED"],
            "ter": ["TERMINATED"],
            "enr": ["ENROLLING_BY_INVITATION"],
            "sus": ["SUSPENDED"],
            "wit": ["WITHDRAWN"],
            "unk": ["UNKNOWN"],
        },
    ),
    "sex": ("sex", {"f": ["FEMALE", "ALL"], "m": ["MALE", "ALL"]}),
    "healthy": ("healthy_volunteers", {"y": [True]}),
    "studyType": (
        "study_type",
        {"int": ["INTERVENTIONAL"], "obs": ["OBSERVATIONAL"], "exp": ["EXPANDED_ACCESS"]},
    ),
    "phase": (
        "phase",
        {"0": ["EARLY_PHASE_1"], "1": ["PHASE_1"], "2": ["PHASE_2"], "3": ["PHASE_3"], "4": ["PHASE_4"]},
    ),
}


def agg_filters(df: DataFrame, text: str) -> DataFrame:
    """``"results:with,status:not rec"``: options of one filter are alternatives, filters all hold."""
    for part in re.split(r"[,|]", text):
        name, _, keys = part.partition(":")
        column, options = AGG_OPTIONS[name.strip()]
        values = [v for k in keys.split() for v in options[k]]
        df = df.filter(F.col(column).isin(*values))
    return df


def filter_list_size(df: DataFrame, c: str, low: int | None = None, high: int | None = None) -> DataFrame:
    size = F.array_size(c)
    kept = size.isNotNull()
    if low is not None:
        kept = kept & (size >= low)
    if high is not None:
        kept = kept & (size <= high)
    return df.filter(kept)


def _declared(schema: T.DataType, path: str) -> bool:
    """Whether a dotted path leads through structs, and arrays of them, to a declared field."""
    for part in path.split("."):
        while isinstance(schema, T.ArrayType):
            schema = schema.elementType
        if not isinstance(schema, T.StructType) or part not in schema.names:
            return False
        schema = schema[part].dataType
    return True


def project_fields(df: DataFrame, fields: Sequence[str], json_col: str | None = None) -> DataFrame:
    """Nested fields by path; a branch keeps all its descendants. Columns are named by the path.

    Declared fields keep their type. Any other path is read from the record's text in ``json_col``: a scalar
    as text, a branch or list as JSON text, null where a record lacks it.
    """

    def column(path: str) -> Column:
        if json_col is None or _declared(df.schema, path):
            return F.col(path)
        return F.get_json_object(json_col, "$." + path)

    return df.select(*[column(f).alias(f.replace(".", "_")) for f in fields])


def filter_synonyms(
    df: DataFrame, pairs: Sequence[tuple[str, int]], synonyms: DataFrame, areas: Mapping[str, DataFrame], key: str
) -> DataFrame:
    """Rows that have, for every (area, synonym id), some value of the area with that synonym.

    ``synonyms`` is (area, synonym_id, term); an area is a table of (key, term).
    """
    for area, synonym_id in pairs:
        terms = synonyms.filter((F.col("area") == area) & (F.col("synonym_id") == synonym_id)).select("term")
        having = areas[area].select(key, F.lower("term").alias("term")).join(terms, "term", "left_semi")
        df = df.join(having.select(key), key, "left_semi")
    return df


def _directions(df: DataFrame, sort: Sequence[str]) -> list[tuple[str, str]]:
    """``"field[:asc|desc]"``; dates and relevance fall by default, numbers rise."""
    if len(sort) > 2:
        raise ValueError("at most two sort fields")
    types = dict(df.dtypes)
    out = []
    for item in sort:
        name, _, direction = item.partition(":")
        falling = types[name].startswith(("date", "timestamp")) or name == "relevance"
        out.append((name, direction or ("desc" if falling else "asc")))
    return out


def sort_studies(df: DataFrame, sort: Sequence[str], tie: str = "nct_id") -> DataFrame:
    keys = [
        F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last() for c, d in _directions(df, sort)
    ]
    return df.orderBy(*keys, F.col(tie).asc())


def page_studies(
    df: DataFrame,
    sort: Sequence[str],
    after: Sequence | None = None,
    page_size: int = 10,
    tie: str = "nct_id",
) -> DataFrame:
    """One page in sort order. ``after`` holds the sort values and the id of the last row seen.

    Keyset paging: the filter skips earlier pages in the scan, and the page itself is a top-k, so a
    late page costs the same as the first.
    """
    keys = _directions(df, sort)
    if after is not None:
        beyond, equal = F.lit(False), F.lit(True)
        for (c, direction), value in zip([*keys, (tie, "asc")], after, strict=True):
            column = F.col(c)
            if value is None:
                equal = equal & column.isNull()
                continue
            further = column < F.lit(value) if direction == "desc" else column > F.lit(value)
            beyond = beyond | (equal & (further | column.isNull()))
            equal = equal & (column == F.lit(value))
        df = df.filter(F.coalesce(beyond, F.lit(False)))
    return sort_studies(df, sort, tie).limit(min(page_size or 10, MAX_PAGE))
