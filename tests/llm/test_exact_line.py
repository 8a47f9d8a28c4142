"""Exact dedup and line dedup against brute force, with odd inputs."""

import random

import pytest
from pyspark.sql import functions as F

from planscore.llm.exact_dedup import digest_rows, exact_dedup, merge_runs
from planscore.llm.line_dedup import line_dedup
from tests.llm import brute

SCHEMA = "doc_id long, text string, digest string, n_lines string, id int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 7) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    rows = [(i, "".join(r.choice("ab \t\n") for _ in range(r.randint(0, 6)))) for i in range(300)]
    rows += [(1000 + i, "the same text") for i in range(150)]           # one hot group
    rows += [(2000, None), (2001, ""), (2002, " \n\t "), (2003, "thesametext"),
             (2004, "x" * 300_000), (2005, "x" * 300_000 + " "), (2006, "é b"), (2007, "éb")]
    return rows


def test_exact_dedup_matches_brute_force(spark, texts):
    want = brute.exact(texts)
    got = exact_dedup(frame(spark, texts)).collect()
    assert len(got) == len(texts)
    ids = dict(texts)
    for r in got:
        keep, size, kept, digest = want[(r.id, ids[r.id] or "")]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (keep, size, kept, digest)


def test_exact_dedup_rounds_do_not_change_the_result(spark, texts):
    rows = digest_rows(frame(spark, texts).repartition(5))
    flat = sorted(map(tuple, merge_runs(rows, 1, 2).select("n", "best.id").collect()))
    for rounds, fanin in ((3, 2), (2, 8)):
        assert flat == sorted(map(tuple, merge_runs(rows, rounds, fanin)
                                  .select("n", "best.id").collect()))


def test_exact_dedup_repeats_null_ids_and_empty_table(spark):
    rows = [(5, "a"), (5, "a"), (5, "b"), (None, "c"), (9, "c")]
    got = {(r.id, r.text_sha256): (r.keep_id, r.group_size, r.kept)
           for r in exact_dedup(frame(spark, rows)).collect()}
    assert got[(5, brute.sha("a"))] == (5, 2, True)
    assert got[(5, brute.sha("b"))] == (5, 1, True)
    assert got[(None, brute.sha("c"))] == (None, 2, True)
    assert got[(9, brute.sha("c"))] == (None, 2, False)
    assert exact_dedup(frame(spark, [])).count() == 0


def test_line_dedup_matches_brute_force(spark):
    r = random.Random(5)
    rows = [(i, "\n".join(r.choice("abc") for _ in range(r.randint(1, 9)))) for i in range(200)]
    rows += [(500, None), (501, ""), (502, "\n\n\n\n\n"), (503, "a\na\na\na\na"),
             (504, "\n".join(["l%d" % (k % 700) for k in range(3000)]))]
    got = {x.doc_id: x for x in line_dedup(frame(spark, rows)).collect()}
    for (i, t), want in zip(rows, brute.line_dedup(rows)):
        assert got[i].text == want, (i, t)
        assert got[i].n_lines == (0 if t is None else t.count("\n") + 1)
        left = 0 if got[i].n_removed == got[i].n_lines else want.count("\n") + 1
        assert t is None or left == got[i].n_lines - got[i].n_removed


def test_line_dedup_hot_passage_repeats_and_empty_table(spark):
    shared = "one\ntwo\nthree\nfour"
    rows = [(i, f"own {i}\n{shared}\nend {i}") for i in range(100)]
    got = {x.doc_id: x.text for x in line_dedup(frame(spark, rows)).collect()}
    assert got[0] == f"own 0\n{shared}\nend 0"
    assert all(got[i] == f"own {i}\nend {i}" for i in range(1, 100))
    twice = line_dedup(frame(spark, [(1, shared), (1, shared), (1, "x\n" + shared)])).collect()
    assert sorted(x.text for x in twice) == sorted([shared, shared, "x"])
    empty = line_dedup(frame(spark, []))
    assert empty.count() == 0 and {"text", "n_lines", "n_removed", "id"} <= set(empty.columns)
    assert line_dedup(frame(spark, rows).withColumn("w", F.lit(1))).count() == 100
