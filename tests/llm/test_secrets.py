"""Secret ledger: spans against Python's re, incremental runs."""

import hashlib

import pytest
from pyspark.sql import functions as F

from planscore.llm import secret_ledger as S
from tests.llm import brute

TEXTS = [
    "password = 'hunter2hunter2' and TOKEN: abc", "secret=token:abcdefg", "token==abcde",
    "API_KEY=\"Zm9vYmFy/=\" apikey:short", "é日本 passwd: x1y2z3w4", "AKIA" + "A" * 16,
    "AKIA" + "B" * 15 + " AKIAAKIA" + "C" * 14, "AKIAAKIAAKIA0000", "f" * 24, "f" * 23,
    "x" + "0123456789abcdef" * 4 + "g" + "abc" * 8, "", None, "no secrets here",
    "password:\n'abcdefgh'", "secret :   'a.b-c_d=e+f/g' " * 40,
    "\U0001f600 token=\U0001f600abcdefg token=abcdefg", "x" * 200_000 + " token=abcdefgh",
    "-----BEGIN RSA PRIVATE KEY-----", "passwordpassword=abcdefgh",
]


@pytest.fixture(scope="module")
def files(spark):
    rows = [(i, 0, t, "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "path int, version int, text string, blob string")


def test_spans_match_re(spark, files):
    found, new = S.scan_versions(files)
    rows = found.select("path", S.span_text(S.F.col("findings"), S.BASE_RULES).alias("s"),
                        S.span_text(S.F.col("findings"), S.RULES).alias("all")).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        want = brute.secret_spans(TEXTS[r.path])
        assert (r.s.split(",") if r.s else []) == want, TEXTS[r.path]
        assert set(want) <= set(r.all.split(",") if r.all else [])
    pem = [r for r in rows if r.path == 18][0]
    assert pem.all == "pem:0:31"
    assert new.count() == len({t or "" for t in TEXTS})


def test_only_unseen_blob_and_rule_versions_are_scanned(spark, files):
    first, ledger = S.scan_versions(files)
    ledger = spark.createDataFrame(ledger.collect(), ledger.schema)
    more = spark.createDataFrame([(100, 1, TEXTS[0], "c"), (100, 2, "new token=abcdefg", "c"),
                                  (101, 1, TEXTS[0], "c")], files.schema)
    found, new = S.scan_versions(files.union(more), ledger)
    assert [bytes(r.blob).hex() for r in new.collect()] == [
        hashlib.sha256(b"new token=abcdefg").hexdigest()]
    spans = {(r.path, r.version): len(r.findings) for r in found.collect()}
    assert spans[(100, 1)] == spans[(101, 1)] == spans[(0, 0)] == 1
    assert spans[(100, 2)] == 1
    # a raised rule version rescans every blob, with that rule alone
    rules = (S.Rule("assign", 2, S.RULES[0].pattern, 2, 20), *S.RULES[1:])
    _, again = S.scan_versions(files, ledger, rules)
    rows = again.collect()
    assert len(rows) == len({t or "" for t in TEXTS})
    assert {tuple(r.scanned) for r in rows} == {("assign@2",)}
    assert S.scan_versions(files, ledger.unionByName(again), rules)[1].count() == 0


def test_repeats_nulls_and_empty_table(spark):
    schema = "path int, version int, text string"
    rows = [(1, 1, "token=abcdefg"), (1, 1, "token=abcdefg"), (1, 1, "other"), (None, None, None)]
    found, _ = S.scan_versions(spark.createDataFrame(rows, schema))
    assert sorted(len(r.findings) for r in found.collect()) == [0, 0, 1, 1]
    found, new = S.scan_versions(spark.createDataFrame([], schema))
    assert found.count() == 0 and new.count() == 0


def test_many_matches_in_one_text_take_time_in_proportion(spark):
    """Positions of 200,000 matches of one text, and of chunk ends."""
    import time
    rule = S.RULES[2]

    def run(n):
        token = "0123456789abcdef01234567"
        df = spark.createDataFrame([("é " + f"{token} x" * n,)], "t string")
        t0 = time.perf_counter()
        row = df.select(S.spans(F.col("t"), rule, 2).alias("s")).first()
        return [(x.start, x.end) for x in row.s], time.perf_counter() - t0
    for n in (0, 1, S.CHUNK - 1, S.CHUNK, S.CHUNK + 1):
        got, _ = run(n)
        assert got == [(2 + 26 * i, 26 + 26 * i) for i in range(n)]
    _, small = run(20_000)
    got, large = run(200_000)
    assert got == [(2 + 26 * i, 26 + 26 * i) for i in range(200_000)]
    assert large < 40 * max(small, 0.5)
