"""Near-duplicate linking against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from planscore.llm import minhash_hamming as H
from tests.llm import brute

SCHEMA = "doc_id long, text string, id string, key int, cls string, label int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "c", 2) for r in rows], SCHEMA)


def family(seed=4):
    """Edited copies of a few texts (a continuum of similarities), exact copies, odd texts."""
    r = random.Random(seed)
    rows, i = [], 0
    for base_no in range(4):
        base = [f"w{base_no}x{r.randint(0, 400)}" for _ in range(r.choice([40, 90]))]
        for _ in range(45):
            words = list(base)
            for _ in range(r.randint(0, 8)):
                k = r.randrange(len(words))
                words[k:k + r.randint(0, 1)] = [f"e{r.randint(0, 30)}"]
            rows.append((i, (" " if r.random() < 0.5 else "\n").join(words)))
            i += 1
    rows += [(i + k, rows[3][1].upper()) for k in range(30)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE  two"),
             (905, "two one"), (906, "v " * 60_000), (907, "v v v v v"), (908, "é b c d e")]
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_components_match_brute_force(spark, k):
    rows = family()
    random.Random(1).shuffle(rows)
    got = {r.id: (r.n_shingles, r.component_id) for r in
           H.link_documents(frame(spark, rows), k=k).collect()}
    want = brute.near([(i, t) for i, t in rows if i != 906], k)
    big = got.pop(906)
    assert big == (1, 906 if k == 4 else 906) or big[0] == 1
    same = {i for i, t in rows if brute.shingles(t, k) == brute.shingles("v " * 20, k)}
    assert got[907][1] == min(same | {906})
    for i in same - {906}:
        want.pop(i), got.pop(i)
    assert got == want


def test_one_document_of_each_group_stays(spark):
    rows = family()
    kept = H.keep_one(frame(spark, rows), k=4)
    assert kept.columns == frame(spark, rows).columns
    ids = sorted(r.doc_id for r in kept.select("doc_id").collect())
    linked = H.link_documents(frame(spark, rows), k=4).collect()
    assert ids == sorted({r.component_id for r in linked})


def test_sets_are_exact_in_any_block_size(monkeypatch):
    r = random.Random(0)
    texts = [None, "", " ", "a", "A b", " a  b\tc\nd e ", "é B C d"] + [
        "".join(r.choice("ab cdE\n\t ") for _ in range(r.randint(0, 60))) for _ in range(300)]
    want = [brute.shingles(t, 3) for t in texts]
    for block in (3, 17, 1 << 21):
        monkeypatch.setattr(H, "BLOCK", block)
        sets = [s for _, ss in H._batches_of(pa.array(texts), 3) for s in ss]
        names: dict = {}
        for s, w in zip(sets, want):
            assert len(s) == len(w) and names.setdefault(s.tobytes(), w) == w
        assert len(names) == len(set(want))


def test_guarantee_of_the_index():
    """Signatures within the guaranteed distance share a key, whatever lanes differ."""
    r = np.random.Generator(np.random.PCG64(1))
    most = H.CHUNKS * (H.ERRORS + 1) - 1
    for _ in range(200):
        differ = r.choice(H.CHUNKS * H.LANES, most, replace=False)
        per_chunk = np.bincount(differ // H.LANES, minlength=H.CHUNKS)
        assert per_chunk.min() <= H.ERRORS


def test_bitmap_bound_never_refutes_a_link():
    r = np.random.Generator(np.random.PCG64(2))
    for _ in range(200):
        a = r.integers(0, 2 ** 64, 300, np.uint64)
        b = np.r_[a[r.random(300) < 0.9], r.integers(0, 2 ** 64, 20, np.uint64)]
        x, y = H.bitmaps([a, b])
        d = sum(bin(int(v)).count("1") for v in (x ^ y).view(np.uint64))
        assert d <= len(np.setxor1d(a, b))


def test_empty_table_and_repeated_ids(spark):
    assert H.link_documents(frame(spark, [])).count() == 0
    assert H.keep_one(frame(spark, [])).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (1, "other words here")]
    got = sorted((r.id, r.component_id) for r in H.link_documents(frame(spark, rows)).collect())
    assert got == [(1, 1), (1, 1), (1, 1), (2, 1)]


def test_one_row_of_repeated_rows_and_shared_ids_stays(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (1, "other words here now"),
            (3, "x y z w v u t"), (3, "a b c d e f"), (4, "hm"), (4, "hm"), (4, "oh"),
            (5, "same id and near"), (5, "same id  and near"), (None, None), (None, None)]
    got = H.keep_one(frame(spark, rows), k=4).select("doc_id", F.regexp_replace("text", " +", " ")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, "a b c d e f"), (1, "other words here now"), (3, "x y z w v u t"), (4, "hm"),
         (4, "oh"), (5, "same id and near"), (None, None)], key=str)
