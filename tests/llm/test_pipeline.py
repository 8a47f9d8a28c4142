"""The pipeline's stages against brute force, each on its own input."""

import random
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline as P
from planscore.llm import entropy_mix, language_id
from planscore.llm.sentencepiece_bpe import default_model
from planscore.session import materialize
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def rows(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()))


def test_stages_keep_the_columns_of_documents(tables):
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing",
                                        "sentencepiece"]
    assert all(t.schema.names == tables[0].schema.names for t in tables[:5])


def test_language_stage_keeps_what_the_operator_accepts(spark, tables):
    docs = tables[0]
    got = language_id.identify(docs, language_id.fit(docs)).collect()
    want = sorted(r.doc_id for r in got if r.lang_pred != "und" and r.score >= P.MIN_SCORE)
    assert [i for i, _ in rows(tables[1])] == want


def test_line_and_near_stages_match_brute_force(tables):
    before = rows(tables[1])
    after = []
    for (i, text), new in zip(before, brute.line_dedup(before)):
        lines, left = text.split("\n"), new.split("\n")
        if new == text or len(lines) > len(left) or (left != [""]):
            if not (new == "" and text != ""):
                after.append((i, new))
    assert rows(tables[2]) == sorted(after)
    assert all(r.n_chars == len(r.text) for r in tables[2].collect())
    comp = brute.near(after, 5)
    assert [i for i, _ in rows(tables[3])] == sorted(i for i, (_, c) in comp.items() if i == c)


def test_mix_and_encoding_stages(tables):
    copies = {r.id: r.copies for r in entropy_mix.mix_rates(tables[3]).collect()}
    got = Counter(i for i, _ in rows(tables[4]))
    assert got == {i: c for i, c in copies.items() if c}
    sp = sentencepiece.SentencePieceProcessor(model_file=default_model())
    text = dict(rows(tables[3]))
    for r in tables[5].collect():
        assert r.token_ids == sp.encode(text[r.doc_id])
        assert r.decoded == sp.decode(r.token_ids) and r.n_tokens == len(r.token_ids)


def test_run_equals_the_stages(spark, tables):
    got = Counter((r.doc_id, tuple(r.token_ids)) for r in P.run(spark, SF).collect())
    assert got == Counter((r.doc_id, tuple(r.token_ids)) for r in tables[5].collect())


def test_odd_documents_pass_all_stages(spark):
    odd = [(1, None, None, None, None, "x", 1.0), (2, "", "en", "s", 0, "x", 1.0),
           (3, "word " * 50_000, "en", None, 9, "x", 1.0), (4, "same text", "en", "s", 9, "x", 1.0),
           (4, "same text", "en", "s", 9, "x", 1.0), (None, "other text", "fr", "t", 9, "x", 1.0)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, "
                                      "n_chars long, lang_pred string, score double")
    for frame in (docs, docs.limit(0)):
        out = frame
        for name, stage in P.STAGES:
            out = materialize(stage(spark, out, SF), f"odd-{name}")
        assert (out.count() == 0) == (frame is not docs)


def test_language_stage_rejects_gibberish_and_unlearned_languages(spark):
    r = random.Random(4)

    def tongue(seed):
        own = random.Random(seed)
        parts = ["".join(own.choice("bcdfghklmnprstvwz") + own.choice("aeiou")
                         for _ in range(2)) for _ in range(30)]
        return lambda n: " ".join(r.choice(parts) + r.choice(parts) for _ in range(n))
    first, second, third = tongue(1), tongue(2), tongue(3)
    for learned in ([first, second], [first]):
        rows = [(i, learned[i % len(learned)](80), f"l{i % len(learned)}") for i in range(200)]
        odd = [(900, learned[0](40) + " " + learned[-1](40), None), (901, third(80), None),
               (902, "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(500)), None),
               (903, learned[0](3) + " 12 34", None)]
        docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
        kept = {x.doc_id for x in P.language_stage(spark, docs, SF).collect()}
        assert kept == set(range(200)) | {900, 903}
