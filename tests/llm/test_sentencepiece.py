"""SentencePiece merge rounds against the library."""

import hashlib
import random

import pytest
import sentencepiece

from planscore.llm import sentencepiece_bpe as B


@pytest.fixture(scope="module")
def tables():
    return B.load_tables(B.default_model())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=B.default_model())


def texts():
    r = random.Random(2)
    parts = ["a", "b", " ", "  ", "   ", "\n", "\t", "é", "中", "文", "😀", "▁", "the", "ing",
             "\x00", "0", ".", " " * 17, "ß", "aaaa", "<s>", "<0x0A>", "ﬁ", "́"]
    out = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(1500)]
    out += ["".join(chr(r.choice([r.randint(32, 126), r.randint(160, 0x24ff),
                                  r.randint(0x4e00, 0x9fff), r.randint(0x1f300, 0x1f6ff)]))
                    for _ in range(r.randint(1, 100))) for _ in range(100)]
    return out + ["", " ", " " * 3000, "a" * 5000, "word " * 30_000,
                  "".join(r.choice("abcdefghij0123456789+/") for _ in range(8000))]


def digests(library, text):
    ids = library.encode(text)
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_ids_and_decoded_text_equal_the_library(tables, library):
    rows = texts()
    enc = B.Encoder(tables)
    for text, parts in zip(rows, B.encoded(enc, rows)):
        assert B._digests(parts) == digests(library, text), text[:80]
        assert B.decode_ids(tables, library.encode(text)) == library.decode(library.encode(text))


def test_blocks_do_not_change_the_result(tables, library, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_CHARS", 7)
    monkeypatch.setattr(B, "NEW_CHARS", 5)
    monkeypatch.setattr(B, "CACHE_WORDS", 3)
    rows = texts()[:300]
    for size in (1, 9):
        for text in rows:
            flat = [w for b in B.blocks(text, size) for w in b]
            assert flat == text.replace("▁", " ").split(" ")
    for text, parts in zip(rows, B.encoded(B.Encoder(tables), rows)):
        assert B._digests(parts) == digests(library, text), text[:80]


def test_frames_nulls_clashes_and_empty_table(spark, tables, library):
    rows = [(1, "Hello  world", 5), (1, "Hello  world", 5), (None, None, None), (2, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = B.encode_digests(df, tables).collect()
    assert len(got) == 4
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(library, r.text or "")
    back = B.encode_decode(df, tables).collect()
    assert all(r.token_ids == library.encode(r.text or "") and r.decoded == (r.text or "")
               and r.n_tokens == len(r.token_ids) for r in back)
    again = B.decode_texts(spark.createDataFrame([([1318, 3, 28724],), (None,)],
                                                 "token_ids array<int>"), tables).collect()
    assert [r.decoded for r in again] == ["x\x00y", ""]
    assert B.encode_digests(df.limit(0), tables).count() == 0


def test_unsupported_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    with open(B.default_model(), "rb") as f:
        m.ParseFromString(f.read())
    m.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m.model").write_bytes(m.SerializeToString())
    with pytest.raises(ValueError):
        B.load_tables(str(tmp_path / "m.model"))
