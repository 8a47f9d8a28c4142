"""Vector columns: which rows hold a usable vector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole(df: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector is not null and has finite entries only (empty vectors stay)."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return df.filter(v.isNotNull() & ~F.coalesce(bad, F.lit(False)))
