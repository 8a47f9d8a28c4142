"""Mixing sources to target weights by entropy balancing.

Document rates ``r_d`` in (0, cap) are the ones closest to 1 in (bounded) entropy that meet one
token constraint per source, ``sum(size_d * r_d) = target_s``. The convex dual has one multiplier
per source and the rates are exponential tilts of the document's size:

    r_d = cap / (1 + (cap - 1) * exp(-lambda_s * size_d / mean_size_s))

(``lambda = 0`` gives rate 1). The dual is solved by distributed Newton iterations: each iteration
aggregates the constraint and its derivative over the (source, size) histogram of all documents,
and updates every source's multiplier in its own row, inside a bracket that makes it safe. The
dual separates by source, so no matrix and no multiplier visits the driver, only the largest
relative error. Sums use decimals, so the order in which rows arrive cannot change the result.

Rates are rounded into whole copies by systematic sampling: per source, documents are ordered by
falling size and the fractions of their rates are added up in fixed-point integers; a document
gets one copy more when the running total passes the next half-integer. Neighbours in that order
have nearly the same size, which keeps the words taken near the target. What is still missing or
left over (at most about one document) is then settled by moving single copies of documents that
fit. The running totals come from a range partitioning (a source that holds a third of all rows
spreads over many partitions): each partition adds up its own rows, and one row per partition and
source carries the offset.

Definitions: the size is the number of runs of non-white characters (``[^\\x20\\x09-\\x0D]+``);
null texts have 0. Sources are ordered by code point, null last. A source of size 0 has target 0
and takes nothing. Rows repeated exactly are separate documents with equal rates. An empty table
gives an empty result. Other columns are passed through by :func:`mix_copies`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from planscore.llm.ordering import numbered
from planscore.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
SHIFT = 20                     # fixed-point bits: sums stay exact up to 10^12 documents
ONE = 1 << SHIFT
TOLERANCE = 1e-9               # largest relative error of a constraint
MAX_ITERATIONS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A non-null key that sorts like the source by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1),
                   share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``sizes``: key, size, docs per source. Adds ``weight`` (cycling in key order) and
    ``target``: ``share`` of all sizes dealt out by weight, at most ``cap`` times the source's
    size; what a capped source leaves is dealt out again by weight until none is above."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("position") % len(weights) + 1).cast("int"))
    table = materialize(numbered(sizes, F.col("key")).withColumn("weight", w), "source-weights")
    total = table.agg(F.sum("size")).first()[0] or 0
    level, capped = 0.0, -1
    # water level: every pass caps more sources; two sums and a count reach the driver
    while True:
        over = F.col("weight") * level >= F.col("size") * cap
        full, rest, n = table.agg(
            F.coalesce(F.sum(F.when(over, F.col("size") * cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(over.cast("long")), F.lit(0))).first()
        if rest == 0 or n == capped:
            break
        capped, level = n, (share * total - full) / rest
    return table.withColumn("target", F.least(F.col("weight") * level, F.col("size") * cap))


def rate(lam: Column, x: Column, cap: float) -> Column:
    """Tilted rate; ``lam`` null stands for the limit (every document at the cap)."""
    z = F.greatest(F.least(-lam * x, F.lit(700.0)), F.lit(-700.0))
    return F.when(lam.isNull(), F.lit(cap)).otherwise(cap / (1 + (cap - 1) * F.exp(z)))


def solve_dual(hist: DataFrame, targets: DataFrame, cap: float = 2.0) -> DataFrame:
    """``hist``: key, size, docs. ``targets``: key, size, docs (totals), target. Returns ``key,
    size, target, mean, lam`` per source; ``lam`` is null where the target is the cap."""
    state = materialize(targets.select(
        "key", "size", "target", (F.col("size") / F.col("docs")).alias("mean"),
        F.when(F.col("target") < F.col("size") * cap * (1 - 1e-12), F.lit(0.0)).alias("lam"),
        F.lit(-1e9).alias("lo"), F.lit(1e9).alias("hi")), "dual")
    for _ in range(MAX_ITERATIONS):
        s = state.filter("lam is not null and size > 0").select("key", "mean", "lam")
        x = F.col("size") / F.col("mean")
        r = rate(F.col("lam"), x, cap)
        words = F.col("size") * F.col("docs")
        sums = (hist.join(s, "key").groupBy("key").agg(
            F.sum((words * r).cast("decimal(38,9)")).cast("double").alias("got"),
            F.sum((words * x * r * (1 - r / cap)).cast("decimal(38,12)")).cast("double")
            .alias("slope")))
        err = F.col("got") - F.col("target")
        lo = F.when(err < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(err > 0, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - F.greatest(F.least(
            F.try_divide(err, F.col("slope")), F.lit(8.0)), F.lit(-8.0))
        inside = (step > lo) & (step < hi)
        state = materialize(
            state.join(sums, "key", "left").select(
                "key", "size", "target", "mean",
                F.when(F.col("got").isNull() | (F.abs(err) <= TOLERANCE * F.col("target")),
                       F.col("lam")).when(inside, step).otherwise((lo + hi) / 2).alias("lam"),
                F.coalesce(lo, "lo").alias("lo"), F.coalesce(hi, "hi").alias("hi"),
                F.coalesce(F.abs(err) / F.col("target"), F.lit(0.0)).alias("err")), "dual")
        worst = state.agg(F.max("err")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state.select("key", "size", "target", "mean", F.round("lam", 12).alias("lam"))


def copies(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows``: key, size, rate, and the ``order`` columns. Adds ``copies`` (systematic sampling
    of the rates' fractions per key, in the order of falling size)."""
    parts = materialize(
        rows.withColumn("_neg", -F.col("size")).repartitionByRange("key", "_neg", *order)
        .withColumns({"_pid": F.spark_partition_id(), "_base": F.floor("rate"),
                      "_fx": F.round((F.col("rate") - F.floor("rate")) * ONE).cast("long")}),
        "mix-rates")
    sums = parts.groupBy("key", "_pid").agg(F.sum("_fx").alias("_sum"))
    before = (W.partitionBy("key").orderBy("_pid")       # one row per partition and source
              .rowsBetween(W.unboundedPreceding, -1))
    offsets = sums.select("key", "_pid", F.coalesce(F.sum("_sum").over(before), F.lit(0))
                          .alias("_off"))
    upto = (W.partitionBy("key", "_pid").orderBy("_neg", *order)
            .rowsBetween(W.unboundedPreceding, W.currentRow))
    total = F.col("_off") + F.sum("_fx").over(upto) + ONE // 2

    def whole(v: Column) -> Column:
        return F.shiftright(v, SHIFT)
    return (parts.join(offsets, ["key", "_pid"])
            .withColumns({"_total": total, "_row": F.count("*").over(upto)})
            .withColumn("copies", F.col("_base") + whole(F.col("_total"))
                        - whole(F.col("_total") - F.col("_fx")))
            .drop("_base", "_fx", "_neg", "_off", "_total"))


def settled(rows: DataFrame, cap: float, passes: int = 5) -> DataFrame:
    """Move single copies until each source's words are nearer its target. ``rows``: the result
    of :func:`copies` with ``target``. In each pass every source changes the copy count of one
    document by one: the document whose size comes nearest to the source's remaining error, if
    that lowers the error. One candidate per source and task is shuffled."""
    at = ["key", "_pid", "_row"]
    rows = materialize(rows, "mix-copies")
    miss = materialize(rows.groupBy("key").agg(
        (F.max("target") - F.sum(F.col("size") * F.col("copies"))).alias("miss")), "mix-miss")
    moves = None
    for _ in range(passes):
        free = rows if moves is None else rows.join(moves.select(*at), at, "left_anti")
        off = F.abs(F.abs(F.col("miss")) - F.col("size"))
        can = F.when(F.col("miss") > 0, F.col("copies") + 1 <= cap).otherwise(F.col("copies") > 0)
        best = (free.join(miss, "key").filter(can & (F.col("size") > 0)
                                              & (off < F.abs(F.col("miss"))))
                .groupBy("key", "miss").agg(F.min(F.struct(
                    off.alias("off"), F.col("_pid"), F.col("_row"), F.col("size"))).alias("b")))
        sign = F.when(F.col("miss") > 0, 1).otherwise(-1)
        step = materialize(best.select("key", "b._pid", "b._row", sign.alias("by"),
                                       (F.col("miss") - sign * F.col("b.size")).alias("now")),
                           "mix-moves")
        if step.isEmpty():
            break
        miss = materialize(miss.join(step, "key", "left").select(
            "key", F.coalesce("now", "miss").alias("miss")), "mix-miss")
        step = step.select(*at, "by")
        moves = step if moves is None else moves.union(step)
    if moves is None:
        return rows.drop("_pid", "_row")
    return (rows.join(moves, at, "left")
            .withColumn("copies", F.col("copies") + F.coalesce("by", F.lit(0)))
            .drop("by", "_pid", "_row"))


def mix_rates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source", weights: Sequence[float] = (5, 2, 1),
              share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per document: ``id, key, h, size, source_size, target, rate, copies``; ``h``
    is a hash of the text, which with the id identifies the row."""
    docs = materialize(df.select(
        F.col(id_col).alias("id"), source_key(F.col(source_col)).alias("key"),
        F.xxhash64(text_col).alias("h"), word_count(F.col(text_col)).alias("size")), "mix-sizes")
    hist = materialize(docs.groupBy("key", "size").agg(F.count("*").alias("docs")), "mix-hist")
    sizes = hist.groupBy("key").agg(F.sum(F.col("size") * F.col("docs")).alias("size"),
                                    F.sum("docs").alias("docs"))
    duals = solve_dual(hist, source_targets(sizes, weights, share, cap), cap)
    duals = duals.withColumnRenamed("size", "source_size")
    x = F.col("size") / F.col("mean")
    rows = docs.join(duals, "key").withColumn(
        "rate", F.when(F.col("size") > 0, rate(F.col("lam"), x, cap)).otherwise(F.lit(0.0)))
    return settled(copies(rows.drop("mean", "lam"), ["h", "id"]), cap)


def mix_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", **kw) -> DataFrame:
    """The mix itself: the input's rows, each as often as it has copies. Rows that share id, text
    and source cannot be told apart; one of them is given as often as all have copies."""
    rates = (mix_rates(df, id_col, text_col, source_col, **kw).groupBy("id", "h", "key")
             .agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
             .filter("_copies > 0")
             .select(F.col("id").alias("_m_id"), F.col("h").alias("_m_h"),
                     F.col("key").alias("_m_key"), "_copies", "_rows"))
    rates = materialize(rates, "mix-rows")

    def of(some: DataFrame) -> DataFrame:
        return df.join(some.hint("shuffle_hash"),
                       F.xxhash64(text_col).eqNullSafe(F.col("_m_h"))
                       & F.col(id_col).eqNullSafe(F.col("_m_id"))
                       & (source_key(F.col(source_col)) == F.col("_m_key")))
    repeated = rates.filter("_rows > 1")
    if repeated.isEmpty():
        out = of(rates)
    else:
        out = of(rates.filter("_rows = 1")).union(
            of(repeated).dropDuplicates(["_m_id", "_m_h", "_m_key"]))
    times = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return out.select(*[df[c] for c in df.columns], times.alias("_m_copy")).drop("_m_copy")


def op6(spark, sf_dir: str) -> DataFrame:
    """``documents`` mixed to weights 5, 2, 1 and 150 % of all words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_rates(docs).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "rate", "copies")
