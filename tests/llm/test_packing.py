"""Best-fit packing: token ids against the library, packings against their rules."""

import random
import time
import zlib

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from planscore.llm import best_fit_packing as B

SCHEMA = "doc_id long, text string, grp string, bin int, id int, fill double"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_str(B.default_tokenizer())


def odd_texts(n=3000):
    r = random.Random(2)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "中", " 文", "😀", "the", " ing", "\x00", "0",
             ".", "'s", "'ll", "<|endoftext|>", " <|endoftext|>", "\xa0", "\x1c", " ", "ß"]
    out = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(n)]
    return out + ["", " ", "x" * 5000, "word " * 3000, " " * 3000, "a b" * 2000]


def test_ids_equal_the_library(library, monkeypatch):
    rows = odd_texts()
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            for t in rows]
    enc = B.Encoder(B.default_tokenizer())
    assert enc.encode(rows) == want and enc.encode(rows) == want
    for name, value in (("BLOCK_CHARS", 50), ("JOIN_CHARS", 7), ("JOIN_BATCH", 2),
                        ("CACHE_CHUNKS", 5), ("CACHE_CHARS", 2)):
        monkeypatch.setattr(B, name, value)
    assert B.Encoder(B.default_tokenizer()).encode(rows[:500]) == want[:500]


def test_chunks_are_told_apart_in_time_that_grows_with_their_length(library):
    """A long word beside a character of another kind (its classification doubled with each letter:
    seconds at 27, a day at 41), among chunks of one kind, of several, too long to keep, and unsafe ones."""
    odd = ["w" * 27 + "中", "w" * 5000 + "中", "a\tb", "\nx", "x\n", "a\n\nb", "a\nb.c", "it's", "é!", ""]
    rows = [" ".join(["of", c, "x1,y", c + "z", "of"]) for c in odd] * 2 + ["plain words, only.\nOf them"]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in rows]
    enc = B.Encoder(B.default_tokenizer())
    start = time.process_time()
    assert enc.encode(rows) == want
    assert time.process_time() - start < 2
    assert [x for t in rows for x in enc.encode([t])] == want and enc.encode(rows[::-1]) == want[::-1]


def test_best_fit_takes_the_smallest_gap_that_holds():
    r = np.random.default_rng(1)
    for n in (0, 1, 50, 400):
        sizes = r.integers(1, 101, n)
        home, offset, fill = B.best_fit(sizes, 100)
        gaps, place = {}, {}
        for i in sorted(range(n), key=lambda i: (-sizes[i], i)):
            fits = [g for g in gaps.values() if g >= sizes[i]]
            if fits:
                assert gaps[home[i]] == min(fits)
            else:
                assert home[i] == i
                gaps[i] = 100
            assert offset[i] == 100 - gaps[home[i]]
            gaps[home[i]] -= sizes[i]
            place[i] = home[i]
        assert all(fill[i] == 100 - gaps[home[i]] for i in range(n))


def check_packing(rows, texts, library, capacity):
    """Every piece is in one place, sequences are gapless and not too long; returns their number."""
    pieces, docs = {}, {}
    for r in rows:
        pieces.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(r.id, []).append(r)
    for parts in pieces.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(docs) == set(texts)
    for i, parts in docs.items():
        ids = library.encode(texts[i] or "", add_special_tokens=False).ids + [0]
        parts.sort(key=lambda r: r.piece)
        assert [x for r in parts for x in r.payload] == ids
        assert [r.piece for r in parts] == list(range(-(-len(ids) // capacity)))
        assert all(r.length == capacity for r in parts[1:])
        assert [r.start for r in parts] == list(np.cumsum([0] + [r.length for r in parts[:-1]]))
    return len(pieces)


@pytest.mark.parametrize("partitions", [1, 23])
def test_packing_rules_and_tree(spark, library, partitions):
    r = random.Random(5)
    texts = {i: " ".join(r.choice(["one", "two", "three,", "\n"])
                         for _ in range(r.choice([0, 3, 10, 18, 200]))) for i in range(700)}
    texts[701], texts[702] = None, "long " * 4000
    df = spark.createDataFrame([(i, t, "g", 1, 2, 0.5) for i, t in texts.items()], SCHEMA)
    df = df.repartition(partitions)
    rows = B.pack(df, capacity=64, fanin=3).collect()
    n = check_packing(rows, texts, library, 64)
    least = -(-sum(x.length for x in rows) // 64)
    # the tree leaves little of what the partitions leave
    assert n <= least * 1.02 + 1
    local = B.local_round(df, "doc_id", "text", B.default_tokenizer(), 64, "ids", 0)
    assert n <= local.select("bin").distinct().count()


def test_underfull_bins_meet_across_all_partitions(spark):
    """One short document in each of 40 partitions: one sequence."""
    df = spark.range(0, 40, 1, 40).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    rows = B.pack(df, fanin=2).collect()
    assert len({r.sequence_id for r in rows}) == 1 and len({r.offset for r in rows}) == 40


def test_nulls_repeats_digests_and_empty_table(spark, library):
    data = [(None, "x y"), (None, "x y"), (1, None), (1, None), (2, "")]
    df = spark.createDataFrame([(i, t, "g", 1, 2, 0.5) for i, t in data], SCHEMA)
    rows = B.pack(df, payload="crc").collect()
    ids = library.encode("x y", add_special_tokens=False).ids + [0]
    assert sorted([(r.id, r.length) for r in rows], key=str) == [
        (1, 1), (1, 1), (2, 1), (None, 3), (None, 3)]
    assert {r.payload for r in rows if r.id is None} == {
        zlib.crc32(np.array(ids, "<u4").tobytes())}
    assert len({r.sequence_id for r in rows}) == 1
    assert B.pack(df.limit(0)).collect() == []


def test_a_worker_keeps_its_encoder_and_a_failed_block_spoils_nothing(library, monkeypatch):
    """Tasks of a worker share what was learnt; a block that ended half way is learnt anew."""
    shared = B.Shared(B.default_tokenizer())
    enc = shared.encoder()
    assert shared.encoder() is enc
    rows = odd_texts(300)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            for t in rows]

    def fails(chunks):
        raise MemoryError
    with monkeypatch.context() as m:
        m.setattr(enc, "_learn", fails)
        with pytest.raises(MemoryError):
            enc.encode(rows)
    assert enc.encode(rows) == want and enc.encode([]) == []


def test_ids_are_dealt_to_their_texts():
    ids = [np.arange(n, dtype="<u4").tobytes() for n in (2, 0, 3)]
    place, ends = np.array([2, 0, 0, 1, 2]), np.array([0, 2, 2, 4, 5])
    assert B._dealt(ids, place, ends) == [ids[2] + ids[0], b"", ids[0], ids[2]]
    assert B._dealt([], np.array([], int), np.array([0, 0])) == [b""]
