"""Optional string collation for the report's inputs (trap T8).

The original server most likely compares names case-insensitively and ignores trailing blanks.
Casting the inputs' string columns to a collated type once, at the boundary, makes every
comparison, ``isin``, ``contains``, join and grouping downstream follow it, with no change to the
operators. Results are cast back to plain strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SERVER_LIKE = "UTF8_LCASE_RTRIM"


def with_collation(df: DataFrame, collation: str) -> DataFrame:
    return df.select(*[F.col(c).cast(f"string collate {collation}").alias(c)
                       if t.startswith("string") else F.col(c) for c, t in df.dtypes])


def without_collation(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) if t.startswith("string collate")
                       else F.col(c) for c, t in df.dtypes])
