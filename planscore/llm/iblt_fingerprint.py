"""Document fingerprints as invertible Bloom lookup sketches.

A text is a set of paragraph digests: its lines, cut into pieces at places that the text itself
marks (``PIECES``; about 30 code points), hashed to 64 bits. The sketch has
``TABLES * CELLS`` cells; a digest goes into one cell of each table, which keeps a count, the
exclusive or of its digests and of their check sums. Two versions' sketches subtract cell by cell: what both have cancels, and
peeling cells that hold a single digest recovers the paragraphs in which the versions differ. When
peeling stops early, the retry uses a sketch four times as large, laid out as four sketches of the
digests' quarters, with cells and quarters hashed anew; only quarters that fail again are split
further. The first sketch is already split in halves by the difference that a quarter of the digests lets expect (a first
stratum), so that most pairs, unrelated texts included, decode without a retry. Every pair ends
decoded.

The likeness of two texts is the Jaccard similarity of their digest sets, from the set sizes and
the number of digests recovered. All steps are SQL functions over arrays. A document and its next
are decoded in the row that has both, retries too; digests are written only for parts that still fail
after ``IN_ROW`` levels of them.

Definitions: null text counts as empty. An empty text has no paragraphs; two texts without
paragraphs are alike 1, one without and one with are 0. Equal texts have equal fingerprints.
Rows repeated exactly are one document for the order (each is reported). "Next" follows falling
document ids (null last), then a hash of the row for rows that share an id; the last one's next is
the first. A table of one document is its own next. An empty table gives an empty result. Other
columns are ignored whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planscore.llm.ordering import numbered
from planscore.session import materialize

TABLES, CELLS = 3, 8           # cells per table: a power of two
LONGEST = 256                  # code points of a paragraph piece that no boundary ends
# A piece ends after a blank that follows one of these letters, after one of these signs, or after one
# of these characters of scripts without blanks: places that the text itself marks, so that an
# insertion changes the pieces that it touches and no others.
BEFORE_BLANK = "bcdfghjyадй"
SIGNS, UNSPACED = "。，、！？；", "のはをに一-兿가-꽿ก-ค"
# most characters fail this one test, which holds for all that begin a mark
MARK_MAY_BEGIN = "bcdfghjyа-яก-\uffff"
PIECES = (rf"[^\n]{{0,{LONGEST - 2}}}?(?=[{MARK_MAY_BEGIN}])(?:[{BEFORE_BLANK}] |[{SIGNS}{UNSPACED}])"
          rf"|[^\n]{{1,{LONGEST}}}")
ROUNDS = 12                    # peeling rounds before a retry
STRATUM_FROM = 9               # two digest bits from here choose the digests that estimate a difference
SPLIT_FROM = 16                # bits below this choose cells, those above it parts
CAPACITY, FIRST_SPLIT = 12, 10  # digests that a sketch peels; halvings of the first one at most
IN_ROW = 3                     # levels of retries in the row that has both texts
KEY = ("k1", "k2")
# a bit for each cell, table by table, and the three cells of a digest by its lowest bits
BITS = [1 << i for i in range(TABLES * CELLS)]
MASKS = [sum(BITS[t * CELLS + (h >> (CELLS.bit_length() - 1) * t) % CELLS] for t in range(TABLES))
         for h in range(CELLS ** TABLES)]

CELL = "struct<n:int,k:bigint,c:bigint>"
SIDES = "struct<a:array<bigint>,b:array<bigint>>"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row (as the start of an empty aggregate; a
    ``transform`` would copy the result, cell by cell)."""
    return F.aggregate(F.array(), value, lambda v, _: v, use)


def either(test: Column, then: Column, otherwise: Column) -> Column:
    """``F.when`` for lambdas: each call of it looks its branches up in a list."""
    return F.call_function("if", test, then, otherwise)


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(3)).bitwiseAND(F.lit(0xFFFFFFFF))


def digests(text: Column) -> Column:
    """Distinct paragraph digests of a text."""
    pieces = F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def cell(n: Column, k: Column, c: Column) -> Column:
    return F.struct(n.alias("n"), k.alias("k"), c.alias("c"))


def itself(digest: Column) -> Column:
    return digest


def anew(level: Column):
    """The bits that choose a digest's cells and part in a retry: others on each ``level``."""
    return lambda digest: F.xxhash64(digest, level)


def item(n: Column, k: Column, c: Column, bits=itself) -> Column:
    """A digest with its cells, one in each table, as a mask of ``BITS``."""
    masks = F.lit(MASKS)
    return F.struct(n.alias("n"), k.alias("k"), c.alias("c"),
                    masks[bits(k).bitwiseAND(F.lit(len(MASKS) - 1)).cast("int")].alias("m"))


def add_to_cells(cells: Column, items: Column, sign: int) -> Column:
    """``cells`` with the ``item``s that fall into them added or taken away."""
    def one_cell(c: Column, bit: Column) -> Column:
        return F.aggregate(
            F.filter(items, lambda x: x.getField("m").bitwiseAND(bit) != 0), c,
            lambda s, x: cell(s.getField("n") + x.getField("n") if sign > 0
                              else s.getField("n") - x.getField("n"),
                              s.getField("k").bitwiseXOR(x.getField("k")),
                              s.getField("c").bitwiseXOR(x.getField("c"))))
    # cells that no item falls into stay as they are
    touched = F.aggregate(items, F.lit(0), lambda m, x: m.bitwiseOR(x.getField("m")))
    return let(touched, lambda m: F.zip_with(cells, F.lit(BITS), lambda c, bit: either(
        m.bitwiseAND(bit) == 0, c, one_cell(c, bit))))


def is_empty(c: Column) -> Column:
    return (c.getField("n") == 0) & (c.getField("k") == 0) & (c.getField("c") == 0)


def empty_cells() -> Column:
    return F.array_repeat(F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"),
                                   F.lit(0).cast("long").alias("c")), TABLES * CELLS)


def sketch(keys: Column, bits=itself) -> Column:
    """Cells of a set of digests."""
    items = F.transform(keys, lambda k: item(F.lit(1), k, check(k), bits))
    return let(items, lambda x: add_to_cells(empty_cells(), x, 1))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: either(is_empty(y), x, cell(
        x.getField("n") - y.getField("n"), x.getField("k").bitwiseXOR(y.getField("k")),
        x.getField("c").bitwiseXOR(y.getField("c")))))


def peel(difference: Column, bits=itself) -> Column:
    """struct(ok, found): digests recovered from a subtracted sketch, with sign ``n`` (1: only in
    the first, -1: only in the second); ``ok`` if nothing is left."""
    none = F.expr(f"cast(array() as array<{CELL}>)")

    def state(cells: Column, found: Column, live: Column) -> Column:
        return F.struct(cells.alias("cells"), found.alias("found"), live.alias("live"))

    def remove(cells: Column, found: Column, pure: Column) -> Column:
        items = F.transform(pure, lambda c: item(c.getField("n"), c.getField("k"),
                                                 c.getField("c"), bits))
        return let(items, lambda x: state(
            add_to_cells(cells, x, -1), F.flatten(F.array(found, pure)), F.lit(True)))

    def left(cells: Column) -> Column:
        return F.filter(cells, lambda c: ~is_empty(c))

    def once(pure: Column) -> Column:
        # a digest may be alone in several cells; its first one counts
        return let(F.transform(pure, lambda c: c.getField("k")), lambda keys: F.filter(
            pure, lambda c, i: F.array_position(keys, c.getField("k")) == i + 1))

    def round_of(now: Column, _: Column) -> Column:
        cells, found = now.getField("cells"), now.getField("found")
        pure = let(F.filter(cells, lambda c: (F.abs(c.getField("n")) == 1)
                            & (check(c.getField("k")) == c.getField("c"))), once)
        # a round without a pure cell is the last one: those after it do nothing, and as each copies
        # the state, only what is left of the cells stays
        return either(now.getField("live"), let(pure, lambda p: either(
            F.size(p) == 0, state(left(cells), found, F.lit(False)), remove(cells, found, p))), now)

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), state(difference, none, F.lit(True)), round_of,
        lambda s: F.struct((F.size(left(s.getField("cells"))) == 0).alias("ok"),
                           s.getField("found").alias("found")))


def fingerprint(cells: Column, size: Column) -> Column:
    """Text form: number of digests, then the cells (count, digests, check sums in hex)."""
    def show(c: Column) -> Column:
        return F.when(c.getField("n") == 0, F.lit("-")).otherwise(F.concat_ws(
            ".", c.getField("n").cast("string"), F.hex(c.getField("k")), F.hex(c.getField("c"))))
    return F.concat(size.cast("string"), F.lit(":"),
                    F.array_join(F.transform(cells, show), ","))


def likeness(a: Column, b: Column, differ: Column) -> Column:
    both = a + b
    return F.when(both == 0, F.lit(1.0)).otherwise((both - differ) / (both + differ))


def sides(a: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"))


def expected_difference(s: Column) -> Column:
    """How many digests the two sides differ by, from a quarter of them; never more than they have."""
    def stratum(keys: Column) -> Column:
        return F.filter(keys, lambda k: F.shiftrightunsigned(k, STRATUM_FROM)
                        .bitwiseAND(F.lit(3)) == 0)
    a, b = s.getField("a"), s.getField("b")
    few = let(sides(stratum(a), stratum(b)), lambda q: 4 * (
        F.size(F.array_except(q.getField("a"), q.getField("b")))
        + F.size(F.array_except(q.getField("b"), q.getField("a")))) + CAPACITY // 2)
    return F.least(few, F.size(a) + F.size(b))


def split(parts: Column, shift, into: int, bits=itself) -> Column:
    """Every part (its two sides) split into ``into`` (a power of two) by bits from ``shift`` on."""
    def piece(keys: Column, q: Column) -> Column:
        return F.filter(keys, lambda k: F.call_function("shiftrightunsigned", bits(k), shift)
                        .bitwiseAND(F.lit(into - 1)) == q)
    return F.flatten(F.transform(parts, lambda s: F.transform(
        F.sequence(F.lit(0), F.lit(into - 1)),
        lambda q: sides(piece(s.getField("a"), q), piece(s.getField("b"), q)))))


def decode(parts: Column, bits=itself) -> Column:
    """struct(differ, failed): the number of digests recovered from the parts' subtracted sketches,
    and the parts that did not decode."""
    def one(s: Column) -> Column:
        return let(peel(subtract(sketch(s.getField("a"), bits), sketch(s.getField("b"), bits)), bits),
                   lambda p: F.struct(
                       either(p.getField("ok"), F.size(p.getField("found")), F.lit(0)).alias("differ"),
                       either(p.getField("ok"), F.lit(None), s).alias("failed")))
    return let(F.transform(parts, one), lambda d: F.struct(
        F.aggregate(d, F.lit(0), lambda t, x: t + x.getField("differ")).alias("differ"),
        F.filter(F.transform(d, lambda x: x.getField("failed")), lambda x: x.isNotNull())
        .alias("failed")))


def first_decode(pair: Column) -> Column:
    """struct(differ, failed): the first sketches of a pair of digest sets, halved as often (at most
    ``FIRST_SPLIT`` times) as the expected difference asks for."""
    times = let(expected_difference(pair), lambda expected: reduce(
        lambda n, k: F.when(expected > CAPACITY * 2 ** k, k + 1).otherwise(n),
        range(FIRST_SPLIT), F.lit(0)))
    parts = let(times, lambda n: F.aggregate(
        F.sequence(F.lit(1), F.lit(FIRST_SPLIT)), F.array(pair), lambda parts, k: either(
            k > n, parts, split(parts, k + (SPLIT_FROM - 1), 2))))
    return let(parts, lambda p: decode(p))


def retry(decoded: Column, level: Column) -> Column:
    """A decode with its failed parts split into quarters and decoded again."""
    bits = anew(level)
    again = decode(split(decoded.getField("failed"), F.lit(SPLIT_FROM), 4, bits), bits)
    return let(again, lambda d: F.struct(
        (decoded.getField("differ") + d.getField("differ")).alias("differ"), d.getField("failed")
        .alias("failed")))


def decode_in_row(pair: Column) -> Column:
    """struct(differ, failed): a pair decoded from its first sketches and ``IN_ROW`` levels of retries."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(IN_ROW)), first_decode(pair), lambda d, level: either(
            F.size(d.getField("failed")) == 0, d, retry(d, level)))


def retried(failed: DataFrame, *ids: str) -> DataFrame:
    """``failed``: ``ids`` and ``failed`` (parts left by the retries in the row). Retries each part in a
    row of its own until every part is decoded: ``ids, differ`` (rows to be added up)."""
    done, level = [], IN_ROW + 1
    part = F.struct(F.lit(0).alias("differ"), F.array("part").alias("failed"))
    while True:
        todo = failed.select(*ids, F.explode("failed").alias("part"), F.lit(level).alias("level"))
        got = materialize(todo.select(*ids, retry(part, F.col("level")).alias("d"))
                          .select(*ids, "d.*"), f"iblt-{level}")
        done.append(got.select(*ids, "differ"))
        failed = got.filter(F.size("failed") > 0)
        if failed.isEmpty():
            return reduce(DataFrame.unionByName, done)
        level += 1


def differences(pairs: DataFrame, *ids: str) -> DataFrame:
    """``pairs``: ``ids`` (distinct), ``a``, ``b`` (digest sets). Adds up the recovered digests:
    ``ids, differ``, retrying parts on their quarters until every pair is decoded."""
    first = materialize(pairs.select(*ids, decode_in_row(sides(F.col("a"), F.col("b"))).alias("d"))
                        .select(*ids, "d.*"), "iblt-0")
    more = retried(first.filter(F.size("failed") > 0), *ids)
    return (first.select(*ids, "differ").unionByName(more).groupBy(*ids)
            .agg(F.sum("differ").alias("differ")))


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """Per row: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next`` (the edited text's last third is the head of the next document)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).alias("id"), text.alias("text")).withColumns({
        "k1": F.xxhash64("id", "text"), "k2": F.xxhash64("text", "id", F.lit(7))})
    keys = docs.groupBy(*KEY).agg(F.max("id").alias("id"), F.max(F.length("text")).alias("n"),
                                  F.count("*").alias("rows"))
    order = numbered(keys, F.desc_nulls_last("id"), F.asc("k1"), F.asc("k2"))
    order = materialize(order, "document-order")
    total, most = order.agg(F.count("*"), F.max("rows")).first()
    # each document learns whose "next" it is, and how much of its head that one needs
    before = order.select(F.pmod(F.col("position") + 1, F.lit(max(total, 1))).alias("position"),
                          F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                          F.floor(F.col("n") / 3).cast("int").alias("take"))
    place_of = order.select(*KEY, "id", "position", "n").join(before, "position").drop(
        "position")
    # both uses below read the same columns of the texts, so one shuffle of them serves both; each
    # cuts its digests after it, as they fill more of a disk than it takes to cut them twice
    own = docs.drop("id").join(place_of.hint("shuffle_hash"), list(KEY))
    heads = own.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"),
                       F.substr("text", F.lit(1), F.col("take")).alias("head"),
                       digests(F.col("text")).alias("next"))
    if most and most > 1:      # rows repeated exactly: one message to the document before
        heads = heads.dropDuplicates(list(KEY))
    cut = F.floor(F.col("n") / 3).cast("int")
    texts = (own.select(*KEY, "id", "text", "n").join(heads.hint("shuffle_hash"), list(KEY))
             .withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("n") - cut), "head")))
    sets = texts.select(
        *KEY, "id", F.col("n").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("a"),
        digests(F.col("edited")).alias("e"), "next")
    rows = materialize(sets.select(
        *KEY, "id", "n_chars", "edited_sha256", F.size("a").alias("size_a"),
        F.size("e").alias("size_e"), F.size("next").alias("size_n"),
        sketch(F.col("a")).alias("cells_a"), sketch(F.col("e")).alias("cells_e"),
        F.transform(F.array(sides(F.col("a"), F.col("e")), sides(F.col("a"), F.col("next"))),
                    decode_in_row).alias("decoded")), "sketches")
    # only the few rows with parts left meet their retries in a join
    unfinished = F.exists("decoded", lambda d: F.size(d.getField("failed")) > 0)
    left = rows.filter(unfinished)
    if most and most > 1:
        left = left.dropDuplicates(list(KEY))
    left = left.select(*KEY, F.posexplode("decoded").alias("kind", "d"))
    more = retried(left.select(*KEY, "kind", "d.failed"), *KEY, "kind").groupBy(*KEY).agg(*[
        F.sum(F.when(F.col("kind") == kind, F.col("differ"))).alias(f"more_{kind}")
        for kind in (0, 1)])

    def near(size: str, kind: int) -> Column:
        return likeness(F.col("size_a"), F.col(size), F.col("decoded")[kind]["differ"]
                        + F.coalesce(F.col(f"more_{kind}"), F.lit(0)))
    finished = rows.filter(~unfinished).withColumns(
        {f"more_{kind}": F.lit(None).cast("long") for kind in (0, 1)})
    return finished.unionByName(rows.filter(unfinished).join(more, list(KEY), "left")).select(
        "id", "n_chars", "edited_sha256",
        fingerprint(F.col("cells_a"), F.col("size_a")).alias("fingerprint"),
        fingerprint(F.col("cells_e"), F.col("size_e")).alias("edited_fingerprint"),
        near("size_e", 0).alias("near_edited"), near("size_n", 1).alias("near_next"))


def op3(spark, sf_dir: str) -> DataFrame:
    """Sketches of ``documents`` and of their edited texts."""
    out = edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.withColumnRenamed("id", "doc_id")
