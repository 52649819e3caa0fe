"""The registered queries: name -> Spark job, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from opinara.session import spread
from opinara.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Reads the tables of one data folder on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @property
    def texts(self) -> DataFrame:
        """The documents, spread over the cores for per-row text work."""
        return spread(self.documents, "doc_id")

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)


def query(name: str, sql: str | None = None):
    """Register ``job(tables)`` under ``name``."""
    def register(job: Callable[[Tables], DataFrame]):
        @wraps(job)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return job(Tables(spark, folder))

        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return job
    return register
