"""Secret scan with an incremental blob ledger.

Every historical version of every file is content-addressed: its blob is the SHA-256 of its text.
The ledger remembers, per blob, which rules (name and version) have scanned it and what they
found. A run scans only blob and rule-version pairs that the ledger lacks, each blob once however
many paths and versions hold it, appends the result to the ledger, and joins the findings back to
all paths. Adding a rule or raising its version rescans every blob with that rule alone.

Spans count code points, end exclusive. Per rule the matches are leftmost and non-overlapping;
a match whose checked group is shorter than the rule's minimum is consumed and dropped. The scan
uses Spark's regular expression functions: a text split at the matches gives the gaps between
them, and the lengths of gaps and matches add up to the positions.

Shuffles: digests and ids for the ledger look-up; the texts once, to the paths that represent an
unseen blob. A blob that a third of all paths share is one row in the ledger look-up (pre-
aggregated per task); the join back to its paths is an equi-join on small rows that AQE splits.

Definitions: null text counts as the empty text, which is a blob without findings. Null paths are
ordinary values. Rows repeated exactly are reported once each. Rows that share path and version
but not the text are reported each by its own text. An empty table gives an empty result. Other
columns are ignored whatever their names.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planscore.session import materialize


@dataclasses.dataclass(frozen=True)
class Rule:
    """``group`` of the match must have ``least`` characters. ``screen`` is an equivalent or
    wider pattern, cheap to test, that a text must contain before it is scanned."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    screen: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules' patterns and lengths. Letters of the assignment rule match in
# either case (ASCII). Runs of a class are maximal either way, so a length written into the
# pattern of `access` and `hex` selects the same matches as a check afterwards.
BASE_RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                      r"""([A-Za-z0-9+/_.=-]+)""", group=2, least=6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
EXTRA_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + EXTRA_RULES

SPAN = "struct<start:int,rule:int,end:int>"
NO_SPANS = f"cast(array() as array<{SPAN}>)"
FINDINGS = "array<struct<name:string,start:int,end:int>>"
NO_FINDINGS = f"cast(array() as {FINDINGS})"


CHUNK = 256        # matches whose positions are added up together


def _chunks(n: Column, size: int) -> Column:
    return F.sequence(F.lit(0), F.floor((n - 1) / F.lit(size)).cast("int"))


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, rule order, end) of the rule's accepted matches in ``text``.

    Positions are prefix sums of the gap and match lengths, taken inside chunks of ``CHUNK`` matches
    first and then over the chunks: an accumulated array is copied at each step, so one run over n
    matches would take n * n / 2 copies."""
    def lengths(parts: Column) -> Column:
        return F.transform(parts, F.length)

    def place(t: Column) -> Column:
        # (gap, match length, checked length) per match, in order
        found = lengths(F.regexp_extract_all(t, F.lit(rule.pattern), F.lit(0)))
        checked = found if rule.group == 0 else lengths(
            F.regexp_extract_all(t, F.lit(rule.pattern), F.lit(rule.group)))
        gaps = lengths(F.split(t, rule.pattern, -1))     # one more than there are matches
        match = F.arrays_zip(gaps.alias("gap"), found.alias("len"), checked.alias("checked"))
        return _let(F.slice(match, F.lit(1), F.size(gaps) - 1), add_up)

    def add_up(match: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.expr(NO_SPANS).alias("found"))

        def step(acc: Column, m: Column) -> Column:
            begin = acc.getField("at") + m.getField("gap")
            end = begin + m.getField("len")
            found = F.when(m.getField("checked") >= rule.least, F.concat(
                acc.getField("found"),
                F.array(F.struct(begin.alias("start"), F.lit(order).alias("rule"),
                                 end.alias("end"))))).otherwise(acc.getField("found"))
            return F.struct(end.alias("at"), found.alias("found"))
        return F.when(F.size(match) > 0, _let(F.transform(
            _chunks(F.size(match), CHUNK),
            lambda c: F.aggregate(F.slice(match, c * CHUNK + 1, F.lit(CHUNK)), start, step)),
            together)).otherwise(F.expr(NO_SPANS))

    def together(chunks: Column) -> Column:
        """The chunks' spans, moved by the lengths of the chunks before: prefix sums again in two
        steps."""
        before = _let(F.transform(chunks, lambda c: c.getField("at")), _exclusive_sums)
        return F.flatten(F.zip_with(chunks, before, lambda c, by: F.transform(
            c.getField("found"), lambda s: F.struct(
                (s.getField("start") + by).alias("start"), s.getField("rule").alias("rule"),
                (s.getField("end") + by).alias("end")))))

    return (F.when(F.rlike(text, F.lit(rule.screen or rule.pattern)), place(text))
            .otherwise(F.expr(NO_SPANS)))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), use).getItem(0)


def _exclusive_sums(lengths: Column) -> Column:
    """Sum of the elements before each, for an array that is not empty."""
    def running(part: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("sums"))
        return F.aggregate(part, start, lambda acc, x: F.struct(
            (acc.getField("at") + x).alias("at"),
            F.concat(acc.getField("sums"), F.array(acc.getField("at"))).alias("sums")))

    def shifted(parts: Column) -> Column:
        totals = running(F.transform(parts, lambda p: p.getField("at"))).getField("sums")
        return F.flatten(F.zip_with(parts, totals, lambda p, by: F.transform(
            p.getField("sums"), lambda x: x + by)))
    return _let(F.transform(_chunks(F.size(lengths), CHUNK), lambda c: running(
        F.slice(lengths, c * CHUNK + 1, F.lit(CHUNK)))), shifted)


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], f"blob binary, scanned array<string>, findings {FINDINGS}")


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scan_unseen(files: DataFrame, paths: DataFrame, ledger: DataFrame,
                rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows for the blob and rule pairs that ``ledger`` lacks (``files``: path, version,
    text; ``paths``: path, version, blob)."""
    names = F.array(*[F.lit(r.name) for r in rules])
    seen = (ledger.select("blob", F.explode("scanned").alias("name")).groupBy("blob")
            .agg(F.collect_set("name").alias("seen")))
    todo = (paths.groupBy("blob").agg(F.min(F.struct("path", "version")).alias("at"))
            .join(seen, "blob", "left")
            .withColumn("scanned", F.array_except(
                names, F.coalesce("seen", F.expr("cast(array() as array<string>)"))))
            .filter(F.size("scanned") > 0)
            .select(F.col("at.path").alias("t_path"), F.col("at.version").alias("t_version"),
                    "blob", "scanned"))
    texts = (files.join(todo.hint("shuffle_hash"),
                        F.col("path").eqNullSafe(F.col("t_path"))
                        & F.col("version").eqNullSafe(F.col("t_version")))
             .filter(blob_of(F.col("text")) == F.col("blob"))
             .select("blob", "scanned", F.coalesce("text", F.lit("")).alias("text")))
    def named(rule: Rule, order: int) -> Column:
        return F.transform(spans(F.col("text"), rule, order), lambda s: F.struct(
            F.lit(rule.name).alias("name"), s.getField("start").alias("start"),
            s.getField("end").alias("end")))
    found = F.concat(*[
        F.when(F.array_contains("scanned", r.name), named(r, i)).otherwise(F.expr(NO_FINDINGS))
        for i, r in enumerate(rules)])
    # rows repeated exactly represent the same blob: one ledger row
    return texts.select("blob", "scanned", found.alias("findings")).dropDuplicates(["blob"])


def scan_versions(files: DataFrame, ledger: DataFrame | None = None,
                  rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """``files``: path, version, text (all historical versions). Returns (findings of every path
    and version: ``path, version, blob, findings``; the new ledger rows, already written).
    Keep the ledger by appending the second to the first."""
    spark = files.sparkSession
    files = files.select("path", "version", "text")
    ledger = empty_ledger(spark) if ledger is None else ledger
    paths = materialize(files.select("path", "version", blob_of(F.col("text")).alias("blob")),
                        "blob-paths")
    new = materialize(scan_unseen(files, paths, ledger, rules), "blob-ledger")
    names = [r.name for r in rules]
    known = (ledger.unionByName(new).select("blob", F.explode("findings").alias("f"))
             .filter(F.col("f.name").isin(names))
             .groupBy("blob").agg(F.collect_set("f").alias("findings")))
    # written, so that AQE can split a blob that many paths share: it splits joins of two plain
    # exchanges, not of an exchange and an aggregate on the same key
    known = materialize(known, "blob-findings")
    out = (paths.join(known, "blob", "left")
           .select("path", "version", "blob", F.coalesce("findings", F.expr(NO_FINDINGS))
                   .alias("findings")))
    return out, new


def span_text(findings: Column, rules: tuple[Rule, ...]) -> Column:
    """``kind:start:end`` of the rules' findings by start, then rule order, comma-joined."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    own = F.filter(findings, lambda f: F.array_contains(
        F.array(*[F.lit(r.name) for r in rules]), f.getField("name")))
    rows = F.array_sort(F.transform(own, lambda f: F.struct(
        f.getField("start").alias("start"), F.element_at(order, f.getField("name")).alias("k"),
        f.getField("end").alias("end"))))
    return F.array_join(F.transform(rows, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s.getField("k") + 1), s.getField("start").cast("string"),
        s.getField("end").cast("string"))), ",")


def count_of(findings: Column, rule: Rule) -> Column:
    return F.size(F.filter(findings, lambda f: f.getField("name") == rule.name)).cast("long")


def op5(spark, sf_dir: str) -> DataFrame:
    """``documents`` as files (path = doc_id, one version each) against an empty ledger; repeated
    texts are scanned once. (Runs on a ledger that knows some blobs are left to ``scan_versions``.)"""
    files = (spark.read.parquet(f"{sf_dir}/documents.parquet")
             .select(F.col("doc_id").alias("path"), F.lit(0).alias("version"), "text"))
    found, _ = scan_versions(files)
    f = F.col("findings")
    return found.select(
        F.col("path").alias("doc_id"),
        *[count_of(f, r).alias(f"n_{r.kind}") for r in BASE_RULES],
        F.sha2(span_text(f, BASE_RULES), 256).alias("base_sha256"),
        span_text(f, RULES).alias("spans"))


def _kind_sql(kind: str, pattern: str, group: int, least: int, order: int) -> str:
    return f"""
  select doc_id, {order} as k, '{kind}' as kind,
         unnest(list_transform(list_filter(range(1, len(m) + 1), lambda i: length(g[i]) >= {least}),
           lambda i: list_sum(list_transform(gap[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0))) as s,
         unnest(list_transform(list_filter(range(1, len(m) + 1), lambda i: length(g[i]) >= {least}),
           lambda i: length(m[i]))) as n
  from (select doc_id, regexp_extract_all(t, '{pattern}') as m,
               regexp_extract_all(t, '{pattern}', {group}) as g,
               string_split_regex(t, '{pattern}') as gap
        from d where regexp_matches(t, '{pattern}'))"""


OP5_SQL = ("with d as (select doc_id, coalesce(text, '') as t from documents),\n"
           "f as (" + "\n  union all".join(
               _kind_sql(r.kind, r.pattern.replace("'", "''"), r.group, r.least, i)
               for i, r in enumerate(RULES)) + """),
s as (select doc_id,
        count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access,
        count(*) filter (where k = 2) as n_hex,
        string_agg(kind || ':' || cast(s as bigint) || ':' || cast(s + n as bigint), ','
                   order by s, k) filter (where k < 3) as base,
        string_agg(kind || ':' || cast(s as bigint) || ':' || cast(s + n as bigint), ','
                   order by s, k) as spans
      from f group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
       coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
       coalesce(spans, '') as spans
from d left join s on d.doc_id = s.doc_id
""")
