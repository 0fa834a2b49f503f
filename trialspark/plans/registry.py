"""Collects the queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from trialspark.plans.tables import Tables, duck_views

AREAS = (
    "harmonizing",
    "geography",
    "retrieving",
    "texts",
    "profiling",
    "searching",
    "lineages",
    "graphs",
    "storing",
    "streams",
)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, views: str = ""):
    """Register a function of :class:`Tables`. ``oracle`` is SQL over the named views."""

    def wrap(build: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        run.__name__, run.__module__, run.__doc__ = name, build.__module__, build.__doc__
        _QUERIES[name] = run
        if oracle is not None:
            sql = oracle.strip()
            if views:
                head = duck_views(*views.split())
                if sql.startswith("WITH RECURSIVE "):
                    sql = f"WITH RECURSIVE {head[5:]},\n{sql[15:]}"
                elif sql.startswith("WITH "):
                    sql = f"{head},\n{sql[5:]}"
                else:
                    sql = f"{head}\n{sql}"
            _ORACLES[name] = sql
        return build

    return wrap


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    for area in AREAS:
        import_module(f"trialspark.plans.{area}")
    return _QUERIES, _ORACLES
