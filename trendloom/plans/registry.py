"""Queries by name, each with DuckDB SQL for the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from trendloom.sources import bindings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Data:
    """Relations and tables of one scale factor, read when first named."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return bindings.table(self._spark, self._dir, name)

    def lines(self, name: str) -> DataFrame:
        """A relation of lines as they come, for what doesn't group them by item."""
        return bindings.relation(self._spark, self._dir, name, by_item=False)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in bindings.RELATIONS:
            raise AttributeError(name)
        return bindings.relation(self._spark, self._dir, name)


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it."""
    env, home = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if home not in (paths := env.get("PYTHONPATH", "").split(":")):
        env["PYTHONPATH"] = ":".join(filter(None, [*paths, home]))


def query(name: str, sql: str | None = None):
    """Registers fn(data) under a name."""

    def register(fn: Callable[[Data], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(Data(spark, sf_dir))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = bindings.with_relations(sql)
        return fn

    return register


def case(column: str, table: dict[str, str]) -> str:
    """A dictionary lookup in SQL."""
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"
