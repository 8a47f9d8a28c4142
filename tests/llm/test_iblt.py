"""Invertible Bloom lookup sketches against brute force."""

import random
import re

from pyspark.sql import functions as F

from planscore.llm import iblt_fingerprint as I
from tests.llm import brute


def units(text):
    return set(re.findall(I.PIECES, text))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """rows: (doc_id, text), distinct ids -> {doc_id: ...}"""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    out = {}
    for k, (i, text) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + nxt[:cut]
        out[i] = (len(text), brute.sha(edited), jaccard(units(text), units(edited)),
                  jaccard(units(text), units(nxt)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, "n") for r in rows],
                                 "doc_id long, text string, id string, n int, k1 string")


def corpus():
    r = random.Random(8)
    lines = [" ".join(r.choice(["aé", "b", "c\U0001f600", "dd"]) for _ in range(r.randint(0, 90)))
             for _ in range(60)]
    rows = [(i * 7, "\n".join(r.choice(lines) for _ in range(r.randint(0, 25))))
            for i in range(150)]
    long = "\n".join(f"line {k} {r.random()}" for k in range(6000))
    return rows + [(2000, None), (2001, ""), (2002, "x"), (2003, long), (2004, long[:-9]),
                   (2005, "\n\n"), (2006, "y" * 50_000), (2007, rows[3][1]), (2008, rows[3][1])]


def test_likeness_and_edited_text(spark):
    rows = corpus()
    got = I.edited_fingerprints(frame(spark, rows)).collect()
    want = expected(rows)
    assert len(got) == len(rows)
    for r in got:
        n, digest, near, nxt = want[r.id]
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        assert abs(r.near_edited - near) < 1e-12 and abs(r.near_next - nxt) < 1e-12
    same = {r.fingerprint for r in got if r.id in (21, 2007, 2008)}
    assert len(same) == 1 and len({r.fingerprint for r in got}) > 100


def test_peeling_recovers_the_difference(spark):
    r = random.Random(9)
    a = [r.getrandbits(63) for _ in range(40)]
    b = a[5:] + [r.getrandbits(63) for _ in range(3)]
    df = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    got = df.select(I.peel(I.subtract(I.sketch(F.col("a")), I.sketch(F.col("b"))))
                    .alias("p")).first().p
    assert got.ok
    assert {x.k for x in got.found if x.n == 1} == set(a[:5])
    assert {x.k for x in got.found if x.n == -1} == set(b[35:])


def test_retries_decode_large_differences(spark):
    r = random.Random(10)
    rows = [(i, [r.getrandbits(63) for _ in range(n)], [r.getrandbits(63) for _ in range(m)])
            for i, (n, m) in enumerate([(0, 0), (0, 9), (30, 40), (700, 20), (3000, 2900)])]
    df = spark.createDataFrame(rows, "i int, a array<long>, b array<long>")
    got = {x.i: x.differ for x in I.differences(df, "i").collect()}
    assert got == {i: len(a) + len(b) for i, a, b in rows}


def test_repeats_single_and_empty_table(spark):
    got = I.edited_fingerprints(frame(spark, [(1, "abcdef"), (1, "abcdef"), (None, "zz")]))
    rows = got.collect()
    assert len(rows) == 3 and {r.edited_sha256 for r in rows if r.id == 1} == {brute.sha("abcdzz")}
    one = I.edited_fingerprints(frame(spark, [(1, "abcdef")])).first()
    assert one.edited_sha256 == brute.sha("abcdab") and one.near_next == 1.0
    assert I.edited_fingerprints(frame(spark, [])).count() == 0


def test_texts_of_different_sizes_share_their_pieces(spark):
    r = random.Random(11)
    a, b, c, d = ("".join(r.choice("abcdefghij ") for _ in range(n)) for n in (450, 50, 395, 10))
    got = I.edited_fingerprints(frame(spark, [(9, a), (8, b)])).collect()
    near = {x.id: x.near_edited for x in got}
    assert near[9] > 0.4                       # 300 of 450 code points are kept, 350 in all
    got = I.edited_fingerprints(frame(spark, [(9, c), (8, c + d)])).collect()
    assert all(x.near_next > 0.8 for x in got)


def test_an_insertion_changes_the_pieces_it_touches(spark):
    """One character in front of a line of 6,000, in its middle, and in front of each line."""
    r = random.Random(4)

    def line(n, alphabet="abcdefghijklmnopqrstuvwxyz", blank=" "):
        out = ""
        while len(out) < n:
            out += "".join(r.choice(alphabet) for _ in range(r.randint(2, 9))) + blank
        return out[:n]
    long = line(6000)
    lines = [line(200) for _ in range(30)]
    han = line(6000, [chr(c) for c in range(0x4e00, 0x9e00)], "")
    pairs = [(long, "x" + long), (long, long[:3000] + "x" + long[3000:]), (long, long[1:]),
             ("\n".join(lines), "\n".join("x" + t for t in lines)), (han, "x" + han)]
    for a, b in pairs:
        got = I.edited_fingerprints(frame(spark, [(2, a), (1, b)])).collect()
        near = {x.id: x.near_next for x in got}[2]
        # an edit in each line of 200 changes one of its two or three pieces
        assert near > (0.2 if a.count("\n") else 0.9), (a[:20], near)
        pieces = re.findall(I.PIECES, a)
        assert "".join(pieces) == a.replace("\n", "") and 8 < len(a) / len(pieces) < 200


def test_pieces_end_at_the_marks_and_nowhere_else(spark):
    """The test that most characters fail first drops no mark: letters, signs and scripts, lines
    longer than the longest piece, characters beyond 16 bits, and the ends of all ranges."""
    r = random.Random(12)
    marks = rf"(?:[{I.BEFORE_BLANK}] |[{I.SIGNS}{I.UNSPACED}])"
    plain = rf"[^\n]{{0,{I.LONGEST - 2}}}?{marks}|[^\n]{{1,{I.LONGEST}}}"
    signs = list("bcdfghjy aeiouадйхя\n  。，、！？；のはをに一兿丂가꽿각กคขฅ\U0001f600\u0e00\uffff\t\r")
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(400)]
    texts += ["a" * n + end for n in (253, 254, 255, 256, 257) for end in ("b c", "。d", " b", "")]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", F.transform(
        F.regexp_extract_all("t", F.lit(plain), F.lit(0)), lambda p: F.xxhash64(p)).alias("w"),
        I.digests(F.col("t")).alias("d")).collect()
    assert all(set(x.w) == set(x.d) for x in got)
    assert all(re.findall(plain, t) == re.findall(I.PIECES, t) for t in texts)


def test_finished_rows_are_not_shuffled_to_meet_retries(spark):
    """Retries happen in the row, so only rows with parts left after them are joined."""
    r = random.Random(13)
    word = lambda: "".join(r.choice("bcdfghjyaeiou") for _ in range(5))
    rows = [(i, " ".join(word() for _ in range(150))) for i in range(60)]
    out = I.edited_fingerprints(frame(spark, rows))
    want = expected(rows)
    assert all(abs(x.near_next - want[x.id][3]) < 1e-12 for x in out.collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    kept = [b for b in plan.splitlines() if "Filter" in b and "exists(decoded" in b]
    assert plan.lstrip().startswith("Union") and any("NOT exists" in b for b in kept)
    pair = spark.createDataFrame([(list(range(700)), list(range(5000, 5900)))],
                                 "a array<long>, b array<long>")
    pair = pair.select(F.transform("a", lambda k: F.xxhash64(k)).alias("a"),
                       F.transform("b", lambda k: F.xxhash64(k)).alias("b"))
    d = pair.select(I.decode_in_row(I.sides(F.col("a"), F.col("b"))).alias("d")).first().d
    assert (d.differ, d.failed) == (1600, [])


def test_texts_are_shuffled_without_their_digests(spark, monkeypatch):
    """Each side cuts its digests after the shuffle of the texts, which two uses share."""
    plans, kept = {}, I.materialize

    def keep(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString().splitlines()
        return kept(df, name)
    monkeypatch.setattr(I, "materialize", keep)
    I.edited_fingerprints(frame(spark, corpus()[:20]))
    hashed = [x for x in plans["sketches"] if re.search(r"xxhash64\(id#\w+, text", x)]
    assert hashed and not any("regexp_extract_all" in x for x in hashed)


def test_a_sketch_holds_each_digest_once_in_each_table(spark):
    r = random.Random(14)
    keys = [r.getrandbits(64) - 2 ** 63 for _ in range(300)]
    rows = [(i, keys[:n]) for i, n in enumerate((0, 1, 7, 300))]
    df = spark.createDataFrame(rows, "i int, a array<long>").select(
        "i", I.sketch(F.col("a")).alias("s"), F.transform("a", I.check).alias("c"))
    for x in df.collect():
        want = [[0, 0, 0] for _ in range(I.TABLES * I.CELLS)]
        for k, c in zip(rows[x.i][1], x.c):
            for t in range(I.TABLES):
                w = want[t * I.CELLS + ((k >> 3 * t) & (I.CELLS - 1))]
                w[0], w[1], w[2] = w[0] + 1, w[1] ^ k, w[2] ^ c
        assert [[c.n, c.k, c.c] for c in x.s] == want
