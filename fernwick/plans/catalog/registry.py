"""Registry of the queries: a Spark callable and, where SQL can say the same, its SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fernwick.session import TABLES, load_table, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Tables whose rows are long texts, with their keys: parsing them should use all cores.
TEXT_KEYS = {"documents": ("doc_id",), "pages": ("page_id",), "conversations": ("conv_id", "turn")}


class Tables:
    """The tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        df = load_table(self.spark, self.folder, name)
        return spread(df, *TEXT_KEYS[name]) if name in TEXT_KEYS else df


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            SQL[name] = sql
        return fn

    return register
