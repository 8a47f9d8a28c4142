"""Lazy access to the parquet tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


class Tables:
    """``Tables(spark, dir).lineitem`` reads ``dir/lineitem.parquet``.

    Reads are lazy DataFrames: Catalyst prunes columns and pushes filters into each scan."""

    @classmethod
    def of(cls, spark: SparkSession, root: str) -> "Tables":
        """A handle for one query: files are listed when the query is built, so files that landed
        since the last query are seen."""
        return cls(spark, root)

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.table(name)
        raise AttributeError(name)
