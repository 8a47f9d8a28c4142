"""Exact dedup by a tree-merge of sorted digest runs.

Every input partition is a run of ``(digest, best row, count)`` records. The runs are merged in
rounds over a binomial tree (``fanin = 2``; wider trees take fewer rounds): in round *r* run ``p``
passes each record to the run whose *r*-th address digit is the digit of the record's digest, so
the runs that differ from each other in that digit exchange disjoint halves of their digests. Each
run is one partition throughout; each receiver sorts what it gets by digest and merges it, one record
per digest with the row that stays. After the last round run ``p`` holds exactly the digests whose
address is ``p``, each once and in order. A digest that a third of all rows share is spread over all
runs at first and halves its records with every round, before they meet.

Only digests, lengths and ids are exchanged; texts are read once. Records are kept apart unless
the SHA-256, the length and an independent 64-bit hash of the normalised text all agree
(*verified* identifiers).

Definitions: null text counts as the empty text. All empty (or all-white-space) texts are one
group. The kept row of a group has the most code points in its original text, then the smallest
``id`` (a null id sorts first). Rows repeated with the same id and text are the same document:
each of them is flagged kept if its id is the kept one. An empty table gives an empty result.
Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planscore.session import materialize

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text without its white space (code points 0x20 and 0x09-0x0D); null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def digest_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One small record per row: ``id``, ``n_chars`` (original) and the verified key
    ``digest, n_norm, chk`` of the normalised text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (df.select(F.col(id_col).alias("id"), F.length(text).alias("n_chars"),
                      normalised(F.col(text_col)).alias("norm"))
            .select("id", "n_chars", F.unhex(F.sha2("norm", 256)).alias("digest"),
                    F.length("norm").alias("n_norm"), F.xxhash64("norm").alias("chk")))


KEY = ("digest", "n_norm", "chk")


def merge_runs(rows: DataFrame, rounds: int, fanin: int = 2) -> DataFrame:
    """Reduce :func:`digest_rows` records to one ``(key, best, n)`` record per verified digest,
    in ``rounds`` exchange rounds over ``fanin ** rounds`` runs.

    A run is a partition (``repartitionById``): in round *r* it keeps the records whose *r*-th
    address digit is its own and sends the others to the ``fanin - 1`` runs that differ from it in
    that digit alone. What meets there is sorted by key and merged in the same pass, within the
    partition."""
    runs = fanin ** rounds
    rec = rows.select(
        F.pmod(F.spark_partition_id(), F.lit(runs)).cast("int").alias("run"), *KEY,
        F.struct((-F.col("n_chars")).alias("neg_len"), "id").alias("best"),
        F.lit(1).cast("long").alias("n"))
    address = F.pmod(F.col("chk"), F.lit(runs))

    def digit(x: Column, r: int) -> Column:
        return F.floor(x / F.lit(fanin ** r)) % F.lit(fanin)
    for r in reversed(range(rounds)):
        to = F.col("run") + (digit(address, r) - digit(F.col("run"), r)) * F.lit(fanin ** r)
        rec = (rec.withColumn("run", to.cast("int")).repartitionById(runs, "run")
               .groupBy("run", *KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n")))
    return rec.select(*KEY, "best", "n")


def rounds_for(df: DataFrame, fanin: int = 2) -> int:
    """Rounds until there are at least as many runs as shuffle partitions."""
    want = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds = 1
    while fanin ** rounds < want:
        rounds += 1
    return rounds


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                fanin: int = 2, rounds: int | None = None) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, n_chars, text_sha256``."""
    rows = materialize(digest_rows(df, id_col, text_col), "digests")
    merged = merge_runs(rows, rounds or rounds_for(df, fanin), fanin)
    return (rows.join(merged, list(KEY))
            .select("id", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
                    (F.col("id").eqNullSafe(F.col("best.id"))
                     & (F.col("n_chars") == -F.col("best.neg_len"))).alias("kept"),
                    "n_chars", F.lower(F.hex("digest")).alias("text_sha256")))


def op10(spark, sf_dir: str) -> DataFrame:
    """``documents``: every row with the row that stays for its normalised text."""
    out = exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      "text_sha256")


OP10_SQL = r"""
with n as (
  select doc_id, coalesce(text, '') as t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as norm
  from documents)
select doc_id,
       first_value(doc_id) over w as keep_id,
       count(*) over (partition by norm) as group_size,
       doc_id = first_value(doc_id) over w as kept,
       sha256(norm) as text_sha256
from n
window w as (partition by norm order by length(t) desc, doc_id)
"""
