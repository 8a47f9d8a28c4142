"""Result sink (S9): tab-separated report with the original header, NULL printed as ``NULL``.

Files go under the session's shared ``spark.checkpoint.dir`` (never a machine-local folder on a
cluster); the writer sorts by program, the only order the report defines."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planscore.session import checkpoint_dir

# The report's column headers, in output order.
REPORT_HEADERS = (("output", "Output"), ("mega_process", "Mega Process"), ("owner", "MPO"),
                  ("process", "Process"), ("program", "PDC Program"),
                  ("unit_of_measure", "Unit of Measure"), ("phase", "Phase"), ("plan", "Plan"),
                  ("completions", "Completions"), ("pct_to_plan", "% to Plan"),
                  ("on_track", "On Track"), ("rag", "RAG"))

REPORT_SCHEMA = T.StructType(
    [T.StructField(h, T.DoubleType() if c in ("plan", "completions", "pct_to_plan")
                   else T.StringType()) for c, h in REPORT_HEADERS])

BLANK_COLUMNS = ("unit_of_measure", "on_track", "rag")


NUMERIC_COLUMNS = ("plan", "completions", "pct_to_plan")


# 15 digits, rounded from the double's exact value
SCIENTIFIC = "0." + "0" * 14 + "E0"
DIGITS, MOST_DECIMALS = 15, 18    # decimals of the smallest numbers scaled without it


def report_number_text(c: Column) -> Column:
    """Numbers as the report prints them: 15 significant digits, plain decimals at any size, no
    trailing zeros. NaN and infinities print as Spark casts them.

    Most numbers are scaled to 15 digits before the point by one multiplication with a power of ten
    that is exact. Its rounding never crosses a half, so unless the product is a half itself, the
    nearest whole number is that of the exact value too; ``format_number`` settles halves."""
    size = F.abs(c)
    decimals = F.when(size >= 10.0 ** (DIGITS - 1), 0)
    for k in range(1, MOST_DECIMALS):
        decimals = decimals.when(size >= 10.0 ** (DIGITS - 1 - k), k)
    decimals = decimals.otherwise(MOST_DECIMALS)
    scaled = size * F.get(F.lit([10.0 ** k for k in range(MOST_DECIMALS + 1)]), decimals)
    beyond = scaled - F.floor(scaled)
    half = F.replace(F.substring_index(F.call_function("format_number", size, F.lit(SCIENTIFIC)),
                                       "E", 1), F.lit("."), F.lit("")).cast("long")
    digits = (F.when(beyond == 0.5, half).when(beyond > 0.5, F.floor(scaled) + 1)
              .otherwise(F.floor(scaled))).cast("string")
    width = F.greatest(F.lit(DIGITS), decimals + 1)
    plain = F.overlay(F.lpad(digits, width, F.lit("0")), F.lit("."), width - decimals + 1, F.lit(0))
    plain = F.rtrim(F.rtrim(plain, F.lit("0")), F.lit("."))
    usual = ((scaled >= 10.0 ** (DIGITS - 1)) & (scaled < 10.0 ** DIGITS - 1)
             & ~F.typeof(c).startswith("decimal"))
    return F.when(usual, F.concat(F.when(c < 0, "-").otherwise(""), plain)).otherwise(
        F.transform(F.array(F.call_function("format_number", c, F.lit(SCIENTIFIC))),
                    lambda sci: _number_text(c, sci)).getItem(0))


def _number_text(c: Column, sci: Column) -> Column:
    """The same for any number, from its ``SCIENTIFIC`` form."""
    digits = F.regexp_replace(F.regexp_extract(sci, r"^-?([0-9.]+)E", 1), r"\.", "")
    power = F.regexp_extract(sci, r"E(-?[0-9]+)$", 1).try_cast("int")
    whole = (F.when(power < 0, "0")
             .otherwise(F.rpad(F.substr(digits, F.lit(1), power + 1), power + 1, F.lit("0"))))
    rest = (F.when(power < 0, F.concat(F.repeat(F.lit("0"), -power - 1), digits))
            .otherwise(F.substr(digits, power + 2, F.lit(15))))
    rest = F.regexp_replace(rest, "0+$", "")
    plain = F.concat(F.when(c < 0, "-").otherwise(""), whole,
                     F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""))
    return F.when(c == 0, "0").when(power.isNull(), c.cast("string")).otherwise(plain)


def write_report_tsv(report: DataFrame, path: str, single_file: bool = False) -> str:
    out = report.select(*[(report_number_text(F.col(c)) if c in NUMERIC_COLUMNS else F.col(c))
                          .alias(h) for c, h in REPORT_HEADERS])
    out = out.orderBy("PDC Program")
    if single_file:
        # The report is programs x phases rows; one file is what a report consumer expects.
        out = out.coalesce(1)
    (out.write.mode("overwrite").option("sep", "\t").option("header", True)
     .option("nullValue", "NULL").option("emptyValue", "").csv(path))
    return path


def read_report_tsv(spark, path: str, texts: bool = False) -> DataFrame:
    """The report's columns; with ``texts`` also the numbers as printed (``plan_text``, ...)."""
    schema = T.StructType([T.StructField(h, T.StringType()) for _, h in REPORT_HEADERS])
    df = (spark.read.option("sep", "\t").option("header", True).option("nullValue", "NULL")
          .schema(schema).csv(path))
    kinds = dict(zip((c for c, _ in REPORT_HEADERS), (f.dataType for f in REPORT_SCHEMA)))
    df = df.select(*[F.col(f"`{h}`").cast(kinds[c]).alias(c) for c, h in REPORT_HEADERS],
                   *[F.col(f"`{h}`").alias(f"{c}_text") for c, h in REPORT_HEADERS
                     if texts and c in NUMERIC_COLUMNS])
    # A blank string reads back as NULL; these columns are never NULL in the report.
    return df.fillna("", subset=list(BLANK_COLUMNS))


def tsv_roundtrip(report: DataFrame) -> DataFrame:
    spark = report.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/report-tsv-{uuid.uuid4().hex}"
    write_report_tsv(report, path)
    return read_report_tsv(spark, path, texts=True)
