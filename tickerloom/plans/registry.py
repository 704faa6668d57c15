"""The registered queries: each a function of Tables, with the SQL that gives the same rows where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickerloom.plans.fixtures import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] | str = ()):
    """Registers a function (Tables) -> DataFrame under a name."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = with_views(sql, (views,) if isinstance(views, str) else views)
        return f

    return register
