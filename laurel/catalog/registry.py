"""Registry of the checked queries: a Spark function and, where SQL can say it, the oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# Input tables written so far, per application and scale folder. As in a pipeline, the game, box-score,
# award and honour tables are written once and scanned by every query after that.
_WRITTEN: dict[tuple[str, str, str], DataFrame] = {}


class Tables:
    """Test tables of one scale folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _key(self, name: str) -> tuple[str, str, str]:
        return (self.spark.sparkContext.applicationId, self.sf_dir, name)

    def made(self, name: str) -> DataFrame | None:
        return _WRITTEN.get(self._key(name))

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """Input table that is written at most once per application."""
        key = self._key(name)
        if key not in _WRITTEN:
            _WRITTEN[key] = make()
        return _WRITTEN[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(key: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under the operator id `key`."""

    def wrap(fn):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return wrap
