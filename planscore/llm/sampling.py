"""Shared pieces of the two trained operators: the held-out fold, bounded training samples, and
access to Arrow text columns."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from planscore.session import materialize

FOLDS = 5
FEW_CLASSES = 100_000          # class counts that are broadcast


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text is a multiple of 5; a null id is never held out."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(rest == 0, F.lit(False))


def bounded_sample(rows: DataFrame, class_col: str, id_col: str, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of each class, those with the smallest hash of the id; never
    held-out rows, null classes or null ids.

    A class's count sets a hash threshold that leaves ``per_class`` rows and six standard deviations
    more. Rows are dropped by it where they are read, before any exchange: the counts (one row per
    class) are written, and broadcast as long as there are at most ``FEW_CLASSES`` of them. So only a
    few more than ``per_class`` rows of a class are ranked, however many it has. (In the unlikely
    case that the threshold leaves fewer, the class has fewer.)"""
    rows = rows.filter(F.col(class_col).isNotNull() & F.col(id_col).isNotNull()
                       & ~held_out(F.col(id_col)))
    rows = rows.withColumn("_h", F.xxhash64(F.col(id_col), F.lit(11)))
    n = materialize(rows.groupBy(F.col(class_col).alias("_class")).agg(F.count("*").alias("_n")),
                    "class-counts")
    n = F.broadcast(n) if n.count() <= FEW_CLASSES else n
    unit = F.pmod(F.col("_h"), F.lit(1 << 40)) / F.lit(1 << 40)
    wanted = per_class + 6.0 * per_class ** 0.5 + 20
    near = (rows.join(n, F.col(class_col) == F.col("_class"))
            .filter(unit <= F.lit(wanted) / F.col("_n")).drop("_class"))
    w = W.partitionBy(class_col).orderBy("_h", id_col)
    return (near.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= per_class)
            .drop("_h", "_r"))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of an Arrow string column; null as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    return np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8), offsets


# tasks need no installed package: functions travel with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])
