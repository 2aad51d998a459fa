"""The registered queries: a Spark callable each, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnish.functions.draws import Draws
from tarnish.sources.files import read_table

QueryFunction = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFunction] = {}
ORACLES: dict[str, str] = {}

SEED = 42


def query(name: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    def register(function: QueryFunction) -> QueryFunction:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def draws(*key: str) -> Draws:
    """Draws another SQL engine can recompute."""
    return Draws(SEED, key, "md5")
