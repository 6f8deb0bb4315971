"""How queries are registered, and what they share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartorio.session import checkpoint_folder, ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with the SQL it must agree with."""
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession) -> str:
    """A new folder in the shared place, for a query that writes and reads back."""
    return f"{checkpoint_folder(ship(spark))}/written-{uuid.uuid4().hex}"
