"""Line dedup by overlapping three-line windows.

Each text is cut at line feeds; every window of ``width`` consecutive lines is hashed (128 bits).
A window's first occurrence is the one with the smallest ``(id, row hash, position)`` over all
documents; all later occurrences are repeats. The lines covered by a document's repeats are
merged and removed, the others are joined again. Windows of the same document take part like any
others, so a passage repeated inside one document keeps its first copy only. A removed line
always has an equal line at an earlier kept place: nothing is lost, only repeated.

Shuffles carry hashes and positions. Frequent windows shrink to one record per task before the
shuffle (partial aggregation of the minimum); the join back to the occurrences is an equi-join
that AQE can split. Lines are compared byte by byte through their hashes, without trimming.

Definitions: a text with fewer lines than ``width`` has no window and stays. Null stays null and
counts 0 lines; the empty text is one empty line. Rows repeated exactly (same id and text) are
one document, each copy comes out alike. Rows that share an id but not the text are separate
documents. Other columns are passed through untouched whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planscore.session import materialize

ROW = ("_ld_k1", "_ld_k2")


def _row_key(id_col: Column, text: Column) -> list[Column]:
    return [F.xxhash64(id_col, text).alias(ROW[0]),
            F.xxhash64(text, id_col, F.lit(7)).alias(ROW[1])]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def window_hashes(text: Column, width: int = 3) -> Column:
    """Array of (position, h1, h2), one per window of ``width`` consecutive lines."""
    def windows(hashes: Column) -> Column:
        last = F.size(hashes) - F.lit(width)
        at = [lambda i, k=k: F.element_at(hashes, i + F.lit(k + 1)) for k in range(width)]
        return F.when(last >= 0, F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.struct(i.alias("pos"),
                               F.xxhash64(*[a(i).getField("a") for a in at]).alias("h1"),
                               F.xxhash64(*[a(i).getField("b") for a in at]).alias("h2"))))
    # one-element transform: evaluates the split and the line hashes once per text
    line_hashes = F.transform(lines_of(text), lambda x: F.struct(
        F.xxhash64(x).alias("a"), F.xxhash64(x, F.lit(1)).alias("b")))
    return F.transform(F.array(line_hashes), windows).getItem(0)


def repeated_windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     width: int = 3) -> DataFrame:
    """Later occurrences of repeated windows: row key and position."""
    occ = materialize(
        df.select(F.col(id_col).alias("id"), *_row_key(F.col(id_col), F.col(text_col)),
                  F.explode(window_hashes(F.col(text_col), width)).alias("w"))
        .select("id", *ROW, F.col("w.pos").alias("pos"), F.col("w.h1").alias("h1"),
                F.col("w.h2").alias("h2")), "line-windows")
    first = (occ.groupBy("h1", "h2")
             .agg(F.min(F.struct("id", *ROW, "pos")).alias("first"), F.count("*").alias("n"))
             .filter("n > 1"))
    # written, so that AQE can split a frequent window (it does not split below an aggregate)
    first = materialize(first.drop("n"), "repeated-windows")
    here = F.struct("id", *ROW, "pos")
    return (occ.join(first, ["h1", "h2"]).filter(here > F.col("first"))
            .select(*ROW, "pos"))


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               width: int = 3) -> DataFrame:
    """The input with ``text_col`` replaced, plus ``n_lines`` and ``n_removed``
    (``_ld_*`` names are reserved while it runs)."""
    hits = (repeated_windows(df, id_col, text_col, width).groupBy(*ROW)
            .agg(F.collect_set("pos").alias("_ld_pos")))
    covered = F.array_distinct(F.flatten(F.transform("_ld_pos", lambda p: F.sequence(
        p, p + F.lit(width - 1)))))
    text = F.col(text_col)
    n_lines = F.coalesce(F.size(lines_of(text)).cast("long"), F.lit(0).cast("long"))

    def rest(pair: Column) -> Column:
        lines, gone = pair.getField("lines"), pair.getField("gone")
        keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(F.sort_array(keep), lambda i: F.get(lines, i)), "\n")

    kept = F.transform(F.array(F.struct(lines_of(text).alias("lines"), covered.alias("gone"))),
                       rest).getItem(0)
    out = (df.withColumns({c: k for c, k in zip(ROW, _row_key(F.col(id_col), text))})
           .join(hits, list(ROW), "left"))
    gone = F.when(F.col("_ld_pos").isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long")
    cols = [F.when(F.col("_ld_pos").isNull(), text).otherwise(kept).alias(c) if c == text_col
            else F.col(f"`{c}`") for c in df.columns if c not in ("n_lines", "n_removed")]
    return out.select(*cols, F.when(text.isNull(), F.lit(0).cast("long")).otherwise(n_lines)
                      .alias("n_lines"), gone.alias("n_removed"))


def op8(spark, sf_dir: str) -> DataFrame:
    """``documents`` without the later occurrences of repeated three-line windows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_dedup(docs)


OP8_SQL = r"""
with l as (
  select doc_id, text, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos
  from documents),
w as (
  select doc_id, pos, line,
         lead(line, 1) over d as l1, lead(line, 2) over d as l2
  from l window d as (partition by doc_id order by pos)),
r as (
  select doc_id, pos,
         row_number() over (partition by line, l1, l2 order by doc_id, pos) as rn
  from w where l1 is not null and l2 is not null),
gone as (
  select distinct doc_id, pos + k as pos
  from r, (values (0), (1), (2)) v(k) where rn > 1),
kept as (
  select l.doc_id, count(*) as n_lines, count(g.pos) as n_removed,
         coalesce(string_agg(l.line, chr(10) order by l.pos) filter (where g.pos is null), '')
           as text
  from l left join gone g on l.doc_id = g.doc_id and l.pos = g.pos
  group by l.doc_id)
select d.doc_id, case when d.text is null then null else k.text end as text,
       coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_removed, 0) as n_removed
from documents d left join kept k using (doc_id)
"""
