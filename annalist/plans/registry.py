"""Named queries over the driver's tables and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from annalist.functions.fingerprint import SALT_CONF

#: Salt of the registered queries and their SQL, set while a query is built and never left behind.
TEST_SALT = "registered-queries-only"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name (or ``name``) with its oracle."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")

        @wraps(fn)
        def salted(spark: SparkSession, sf_dir: str) -> DataFrame:
            before = spark.conf.get(SALT_CONF, None)
            spark.conf.set(SALT_CONF, TEST_SALT)
            try:
                return fn(spark, sf_dir)
            finally:
                spark.conf.unset(SALT_CONF) if before is None else spark.conf.set(SALT_CONF, before)

        QUERIES[key] = salted
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def load() -> None:
    """Import the modules that register queries."""
    from annalist.plans import flows, governance, history, measures, sweeps  # noqa: F401
