"""Registry of named queries and their independent DuckDB SQL.

Each query is a function ``(spark, sf_dir) -> DataFrame`` over the driver's
tables; the SQL beside it computes the same rows from the same parquet files
in DuckDB (views named after the tables).  Queries without SQL are checked by
row count in the driver and by unit tests here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import the modules that register queries."""
    import importlib
    for m in ("queries_text", "queries_subwords", "queries_rows", "queries_boxes", "queries_eval", "queries_work", "queries_io"):
        importlib.import_module(f"{__package__}.{m}")
