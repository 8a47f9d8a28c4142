"""Hard-negative mining with Four-Russians scoring.

Scores are integer inner products of ``floor(scale * c)``, for every anchor against every row:

1. Candidates are cut into bit planes (two's complement); the eight bits that a group of eight
   dimensions has in a plane are one byte.
2. For an anchor, a table over each group of eight dimensions holds the sums of all 256 subsets of
   its entries.
3. A score is the sum over planes of ``2**plane`` times the looked-up sums of the plane's bytes:
   look-ups are added, the running score is doubled from plane to plane, and the sign plane counts
   negatively. Nothing is multiplied and no score is approximate.

Anchors and rows are dealt by hash into a grid of cells of at most about ``CELL_ANCHORS`` anchors and
``CELL_ROWS`` rows; a cell is one task's group. In a cell the tables of ``TABLE_ANCHORS`` anchors at a
time meet ``CHUNK`` rows at a time. The first pass scores rows of the anchor's label and keeps the
best per anchor and cell; these are ranked into the positives. The second pass scores all rows and
keeps, per anchor and positive, the best rows of other labels inside the window. Only such short lists
leave a cell, and only they are ranked globally.

The work is anchors times rows, as the query set is stated; a label or a vector that a third of all
rows share changes neither the cells nor the lists.

Definitions: rows with a null label, a null vector, or a null or non-finite entry take no part. Empty
vectors score 0; of two vectors of different length the shorter one is filled up with zeros. Every
row counts as a row of its own, rows repeated with the same id included (an anchor never meets
itself, but meets its copies). Ties go to the smaller id, a null id last. Anchors without a positive,
and positives without a row in the window, give no row. Scaled entries are held within the range of a
long; scores are exact if they fit a long and are taken modulo 2**64 otherwise. An empty table gives
an empty result. Columns other than the id, the vector and the label are ignored.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from planscore.llm.vectors import whole
from planscore.session import default_parallelism, materialize

CELL_ANCHORS, CELL_ROWS = 8192, 65536
CELLS_PER_CORE = 8             # small inputs are dealt into at least this many cells a core
TABLE_ANCHORS, CHUNK = 128, 512
LOWEST = np.iinfo(np.int64).min
FOUND = "a_rid long, rid long, vec_id long, score long"
MINED = ("a_rid long, anchor_id long, p_rid long, positive_id long, positive_score long, "
         "negative_id long, negative_score long")


# ---- scoring ---------------------------------------------------------------------------------

def subset_tables(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): sums over all subsets of each group of eight entries. ``anchors``:
    (anchors, 8 * groups) integers."""
    m, d = anchors.shape
    reach = d * max(int(anchors.max(initial=0)), -int(anchors.min(initial=0)))
    kind = np.int16 if reach < 2 ** 15 else np.int32 if reach < 2 ** 31 else np.int64
    parts = np.ascontiguousarray(anchors.T.astype(kind)).reshape(d // 8, 8, m)
    tables = np.zeros((d // 8, 256, m), kind)
    for bit in range(8):
        tables[:, 1 << bit:2 << bit] = tables[:, :1 << bit] + parts[:, bit, None]
    return tables


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes of the two's complement of ``rows``: (rows, 8 * groups)."""
    least = max(int(rows.max(initial=0)), ~int(rows.min(initial=0)))
    planes = 1 + least.bit_length()
    return np.stack([np.packbits(((rows >> p) & 1).astype(np.uint8), axis=1, bitorder="little").T
                     for p in range(planes)])


def scores(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(rows, anchors): exact inner products by look-ups, additions and doubling."""
    planes, groups, n = codes.shape
    m = tables.shape[2]
    single = tables[:, 1 << np.arange(8)]      # the entries themselves
    reach = 8 * groups * max(int(single.max(initial=1)), -int(single.min(initial=0)))
    total = np.zeros((n, m), np.int32 if reach << planes < 2 ** 31 else np.int64)
    plane, looked = np.empty((n, m), tables.dtype), np.empty((n, m), tables.dtype)
    for p in reversed(range(planes)):
        plane[:] = 0
        for g in range(groups):
            np.take(tables[g], codes[p, g], axis=0, out=looked, mode="clip")
            plane += looked
        if p == planes - 1:
            total -= plane
        else:
            total += total
            total += plane
    return total


def best(group, score, vec_id, no_id, rid, k: int) -> np.ndarray:
    """Positions of the first ``k`` of each group by falling score, then id, nulls last."""
    order = np.lexsort((rid, vec_id, no_id, ~score, group))
    g = group[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(first, np.diff(np.r_[first, len(g)]))
    return order[rank < k]


class Best:
    """Running best ``k`` hits of each of ``n`` groups; ``least`` is the score of the ``k``-th."""

    def __init__(self, n: int, k: int):
        self.k, self.least = k, np.full(n, LOWEST)
        self.group = self.row = self.score = np.zeros(0, np.int64)

    def add(self, group, row, score, side: "Side") -> None:
        if not len(group):
            return
        group, row = np.r_[self.group, group], np.r_[self.row, row]
        score = np.r_[self.score, score.astype(np.int64)]
        keep = best(group, score, side.vec_id[row], side.no_id[row], side.rid[row], self.k)
        self.group, self.row, self.score = group[keep], row[keep], score[keep]
        full = np.bincount(self.group, minlength=len(self.least)) == self.k
        last = np.full(len(self.least), np.iinfo(np.int64).max)
        np.minimum.at(last, self.group, self.score)
        self.least = np.where(full, last, self.least)


class Side:
    """One side of a cell as arrays; vectors padded with zeros to ``d`` entries."""

    def __init__(self, t: pa.Table, d: int):
        self.rid, self.label = t["rid"].to_numpy(), t["label"].to_numpy()
        ids = t["vec_id"].combine_chunks()
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.vec_id = ids.fill_null(0).to_numpy(zero_copy_only=False)
        q = t["q"].combine_chunks()
        sizes = q.value_lengths().to_numpy(zero_copy_only=False)
        flat = q.flatten().to_numpy(zero_copy_only=False)
        self.vectors = np.zeros((len(q), d), np.int64)
        self.vectors[np.arange(d) < sizes[:, None]] = flat

    def ids(self, rows: np.ndarray) -> pa.Array:
        return pa.array(self.vec_id[rows], mask=self.no_id[rows])


def sides(left: pa.Table, right: pa.Table) -> tuple[Side, Side]:
    """Anchors and rows of a cell, both padded to a common multiple of eight dimensions."""
    most = max([0] + [int(x) for t in (left, right) for c in t["q"].chunks if len(c)
                      for x in [c.value_lengths().to_numpy(zero_copy_only=False).max()]])
    d = max(8, -(-most // 8) * 8)
    return Side(left, d), Side(right, d)


def _tiles(n: int, size: int):
    return [slice(i, min(n, i + size)) for i in range(0, n, size)]


# ---- cells -----------------------------------------------------------------------------------

def cell_positives(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """Best ``k`` rows of the same label for each anchor of a cell."""
    out = []
    if left.num_rows and right.num_rows:
        a, c = sides(left, right)
        for label in np.unique(a.label):
            mine, rows = np.flatnonzero(a.label == label), np.flatnonzero(c.label == label)
            if not len(rows):
                continue
            codes = bit_planes(c.vectors[rows])
            for tile in _tiles(len(mine), TABLE_ANCHORS):
                anchors = mine[tile]
                tables, found = subset_tables(a.vectors[anchors]), Best(len(anchors), k)
                for part in _tiles(len(rows), CHUNK):
                    s = scores(tables, codes[:, :, part])
                    hit = s >= found.least
                    hit &= c.rid[rows[part], None] != a.rid[anchors]
                    row, col = np.nonzero(hit)
                    found.add(col, rows[part][row], s[row, col], c)
                out.append(pa.table({"a_rid": a.rid[anchors[found.group]],
                                     "rid": c.rid[found.row], "vec_id": c.ids(found.row),
                                     "score": found.score}))
    return pa.concat_tables(out) if out else _empty(FOUND)


def window(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score with ``low * p <= 100 * score <= high * p``; no product leaves a
    long."""
    whole_part, rest = positive // 100, positive % 100
    return (low * whole_part - (-low * rest) // 100, high * whole_part + (high * rest) // 100)


def cell_negatives(left: pa.Table, right: pa.Table, k: int, n_pos: int, low: int,
                   high: int) -> pa.Table:
    """Best ``k`` rows of other labels inside the window of each anchor and positive of a cell.
    ``left`` carries each anchor's positives as lists ``p_rid``, ``p_id``, ``p_score``."""
    out = []
    if left.num_rows and right.num_rows:
        a, c = sides(left, right)
        codes = bit_planes(c.vectors)
        lists = left["p_score"].combine_chunks()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        starts = np.cumsum(np.r_[0, sizes[:-1]])
        p_score = lists.flatten().to_numpy(zero_copy_only=False)
        p_rid = left["p_rid"].combine_chunks().flatten()
        p_id = left["p_id"].combine_chunks().flatten()
        for tile in _tiles(left.num_rows, TABLE_ANCHORS):
            m = tile.stop - tile.start
            slot = np.arange(n_pos) < sizes[tile, None]
            at = np.where(slot, starts[tile, None] + np.arange(n_pos), 0)
            lo, hi = window(p_score[at], low, high)
            lo, hi = np.where(slot, lo, 1), np.where(slot, hi, 0)       # (m, n_pos)
            tables, found = subset_tables(a.vectors[tile]), Best(m * n_pos, k)
            for part in _tiles(right.num_rows, CHUNK):
                s = scores(tables, codes[:, :, part])
                from_ = np.maximum(lo, found.least.reshape(m, n_pos))
                open_ = from_ <= hi
                top = np.iinfo(np.int64).max
                hit = (s >= np.where(open_, from_, top).min(1)) & \
                    (s <= np.where(open_, hi, LOWEST).max(1))
                hit &= c.label[part, None] != a.label[tile]
                row, col = np.nonzero(hit)
                value = s[row, col]
                each, p = np.nonzero((value[:, None] >= from_[col]) & (value[:, None] <= hi[col]))
                found.add(col[each] * n_pos + p, row[each] + part.start, value[each], c)
            mine, p = found.group // n_pos, found.group % n_pos
            pick = pa.array(at[mine, p])
            out.append(pa.table({
                "a_rid": a.rid[tile][mine], "anchor_id": a.ids(tile.start + mine),
                "p_rid": p_rid.take(pick), "positive_id": p_id.take(pick),
                "positive_score": p_score[at[mine, p]],
                "negative_id": c.ids(found.row), "negative_score": found.score}))
    return pa.concat_tables(out) if out else _empty(MINED)


def _empty(schema: str) -> pa.Table:
    return pa.table({f.split()[0]: pa.array([], pa.int64()) for f in schema.split(", ")})


# ---- the operator ----------------------------------------------------------------------------

def _deal(n_cells: int, salt: int) -> Column:
    return F.pmod(F.xxhash64("rid", F.lit(salt)), F.lit(n_cells)).cast("int")


def _grid(anchors: DataFrame, rows: DataFrame, n_a: int, n_c: int):
    """Both sides grouped by cell, ready to be cogrouped."""
    left = (anchors.withColumn("cell_a", _deal(n_a, 1))
            .withColumn("cell_c", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1)))))
    right = (rows.withColumn("cell_c", _deal(n_c, 2))
             .withColumn("cell_a", F.explode(F.sequence(F.lit(0), F.lit(n_a - 1)))))
    return left.groupBy("cell_a", "cell_c").cogroup(right.groupBy("cell_a", "cell_c"))


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label", scale: float = 256.0, n_positives: int = 5, n_negatives: int = 5,
         low: int = 80, high: int = 100) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor
    (rows where ``is_anchor`` holds), its best ``n_positives`` rows of its label and, for each, the
    best ``n_negatives`` rows of other labels that score ``low`` to ``high`` percent of it."""
    spark = df.sparkSession
    rows = whole(df.filter(F.col(label_col).isNotNull()), vec_col)
    rows = materialize(rows.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        F.transform(vec_col, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
        .alias("q")), "mining-rows")
    size = rows.agg(F.count("*"), F.count_if("anchor")).first()
    n_a = max(1, -(-size[1] // CELL_ANCHORS))
    n_c = max(1, -(-size[0] // CELL_ROWS), -(-CELLS_PER_CORE * default_parallelism(spark) // n_a))
    anchors = rows.filter("anchor").drop("anchor")
    rows = rows.drop("anchor")

    def positives_of(left: pa.Table, right: pa.Table) -> pa.Table:
        return cell_positives(left, right, n_positives)

    def negatives_of(left: pa.Table, right: pa.Table) -> pa.Table:
        return cell_negatives(left, right, n_negatives, n_positives, low, high)

    found = _grid(anchors, rows, n_a, n_c).applyInArrow(positives_of, FOUND)
    first = W.partitionBy("a_rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    found = found.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= n_positives)
    lists = found.groupBy("a_rid").agg(F.sort_array(F.collect_list(
        F.struct("r", "rid", "vec_id", "score"))).alias("p"))          # n_positives at most
    anchors = materialize(anchors.join(lists, F.col("rid") == F.col("a_rid")).select(
        "rid", "vec_id", "label", "q", F.col("p.rid").alias("p_rid"),
        F.col("p.vec_id").alias("p_id"), F.col("p.score").alias("p_score")), "mining-anchors")
    mined = _grid(anchors, rows, n_a, n_c).applyInArrow(negatives_of, MINED)
    pair = W.partitionBy("a_rid", "p_rid").orderBy(
        F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    return (mined.withColumn("rank", F.row_number().over(pair)).filter(
        F.col("rank") <= n_negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                "negative_score"))


def op11(spark, sf_dir: str) -> DataFrame:
    """``embeddings``: anchors are ids divisible by 100; labels of ids divisible by 7 move on."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
                           .otherwise(F.col("label")))
    return mine(rows, F.col("vec_id") % 100 == 0)


OP11_SQL = """
with e as (
  select row_number() over () as rid, vec_id,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda c: cast(floor(256 * cast(c as double)) as bigint)) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
s as (
  select a.rid as a_rid, a.vec_id as anchor_id, a.label as a_label, b.rid, b.vec_id, b.label,
         cast(list_sum(list_transform(range(1, greatest(len(a.q), len(b.q)) + 1),
           lambda i: coalesce(a.q[i], 0) * coalesce(b.q[i], 0))) as bigint) as score
  from e a, e b where a.vec_id % 100 = 0 and a.rid <> b.rid),
p as (
  select a_rid, rid as p_rid, vec_id as positive_id, score as positive_score
  from s where label = a_label
  qualify row_number() over (partition by a_rid order by score desc, vec_id nulls last) <= 5)
select s.anchor_id, p.positive_id,
       cast(row_number() over w as integer) as rank, s.vec_id as negative_id,
       p.positive_score, s.score as negative_score
from s join p on s.a_rid = p.a_rid
where s.label <> s.a_label and 80 * p.positive_score <= 100 * s.score
  and 100 * s.score <= 100 * p.positive_score
window w as (partition by s.a_rid, p.p_rid order by s.score desc, s.vec_id nulls last)
qualify row_number() over w <= 5
"""

# tasks need no installed package: functions travel with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])
