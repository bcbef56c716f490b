"""Registered queries and their checking SQL, side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harness.books import Books, duck_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, models: bool = False):
    """Register a function of the derived books under a name, with its checking SQL where there is one.

    models: it depends on the forecast models. Under its name, and checked by SQL, run the models that SQL can express; as
    `<name>_all_models` the same function runs with every model, which is what the library does unless told otherwise."""

    def register(fn: Callable[[Books], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Books.of(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = duck_sql(sql)
        if models:
            QUERIES[f"{name}_all_models"] = lambda spark, sf_dir: fn(Books.of(spark, sf_dir).with_all_models())
        return fn

    return register
