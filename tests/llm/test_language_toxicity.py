"""Held-out accuracy and odd inputs of the two trained operators."""

import random
import zlib

import numpy as np
import pandas as pd
import pytest

from planscore.llm import language_id as L
from planscore.llm import toxicity as X
from planscore.llm.sampling import held_out

SF = "/root/testdata/sf0.01"
ODD = [(None, None, None), (1, "", "en"), (2, "123 ... !!", "en"), (3, "é", None),
       (4, "the of and " * 40_000, "en"), (5, "the of and", "en"), (5, "the of and", "en")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def net(docs):
    return L.fit(docs)


def odd(spark):
    rows = [(*r, "x", 1.0, 2, "y") for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, "
                                       "score double, toxic int, id string")


def test_language_held_out_accuracy(spark, docs, net):
    got = L.op1(spark, SF).toPandas().set_index("doc_id")
    truth = docs.select("doc_id", "lang").toPandas().set_index("doc_id").lang
    out = pd.Series({i: zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index})
    assert (got.held_out == out).all()
    assert (got.lang_pred == truth)[out].mean() >= 0.97
    assert got.score.between(0, 1).all()


def test_language_odd_inputs(spark, net):
    df = odd(spark)
    got = L.identify(df, net).collect()
    assert len(got) == len(ODD)
    by = {(r.doc_id, r.text): r for r in got}
    for key in ((None, None), (1, ""), (2, "123 ... !!")):
        assert (by[key].lang_pred, by[key].score) == ("und", 0.0)
    assert by[(3, "é")].lang_pred in net.labels and by[(5, "the of and")].lang_pred == "en"
    assert by[(4, "the of and " * 40_000)].lang_pred == "en"
    assert L.identify(df.limit(0), net).count() == 0
    assert all(r.lang_pred == "und" for r in L.identify(df, None).collect())
    assert L.fit(df.limit(0)) is None
    assert L.fit(df) is not None           # extra columns named like internal ones


def test_windows_cover_every_byte():
    seen = []

    class Spy:
        labels = ["a"]

        def probabilities(self, x):
            seen.append(x.copy())
            return np.ones((len(x), 1))
    import pyarrow as pa
    text = "".join(chr(97 + (i * 7) % 26) for i in range(1000))
    L.predict_column(Spy(), pa.array([text, None, "ab"]))
    windows = np.concatenate(seen)
    flat = text.encode()
    for width in L.WIDTHS:
        spans = {bytes(w[i:i + width]) for w in windows for i in range(L.WINDOW - width + 1)}
        assert {flat[i:i + width] for i in range(len(flat) - width + 1)} <= spans


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_accepts_exactly_the_allowed_edits():
    terms = [("idiot", True), ("moron", True), ("disgusting", True), ("scu", True)]
    a = X.build_automaton(terms)
    r = np.random.Generator(np.random.PCG64(5))
    words = {t for t, _ in terms}
    for t, _ in terms:
        for _ in range(400):
            w = list(t)
            for _ in range(r.integers(0, 4)):
                k = r.integers(0, len(w) + 1)
                w[k:k + r.integers(0, 2)] = list("xiot"[r.integers(0, 4)]) * r.integers(0, 2)
            words.add("".join(w))
    for w in words:
        state = 1
        for c in w:
            state = a.step[state, a.chars.index(c) if c in a.chars else len(a.chars)]
        best = min((levenshtein(w, t) for t, whole in terms
                    if w[:1] == t[0] and levenshtein(w[1:], t[1:]) <= X.allowed(t, whole)),
                   default=None)
        hit = bool(w) and state != 0 and a.term[state] >= 0
        assert hit == (best is not None), w


def matched(scorer, word):
    _, _, term, edits, n, _ = scorer.matches(f"aa {word} bb")
    assert n == 3
    return [(scorer.terms[t][0], e) for t, e in zip(term.tolist(), edits.tolist())]


def test_edits_at_the_first_character_leading_symbols_and_stems():
    terms = [("asshole", True, 1.0), ("idiot", False, 1.0), ("moron", True, 1.0)]
    counts = {"idiot\n": (9, 0), "idiots\n": (9, 0), "idiotic\n": (9, 0), "moron\n": (9, 0)}
    edits = X.stem_edits(terms, counts)
    assert edits == [1, 1, 1]
    a = X.build_automata([t[:2] for t in terms], edits)
    s = X.Scorer(terms, a, X.letter_bits(), np.zeros(4)).prepare()
    for w, term in [("diot", "idiot"), ("xidiot", "idiot"), ("ydiot", "idiot"), ("oron", "moron"),
                    ("xmoron", "moron"), ("@sshole", "asshole"), ("*diot", "idiot"),
                    ("ixiots", "idiot"), ("idotic", "idiot")]:
        assert matched(s, w) == [(term, 1)], w
    for w, term in [("idiot", "idiot"), ("idiots", "idiot"), ("*moron*", "moron"),
                    ("@idiot", "idiot"), ("@@moron", "moron")]:
        assert matched(s, w) == [(term, 0)], w
    for w in ("xxmoron", "ron", "table", "@"):
        assert not s.matches(w)[2].size


def test_terms_by_rates_and_outside_quotation(spark):
    # 25 % of 200 toxic texts, 0.3 % of 2000 clean ones
    assert [t[:2] for t in X.choose_terms({"idiot\n": (50, 6)}, 200, 2000, 1000)] == [
        ("idiot\n"[:-1], True)]
    texts = ([(i, 1, f"one a{i} idiot zzz") for i in range(20)]
             + [(100 + i, 0, f'he wrote "idiot b{i}" zzz') for i in range(15)]
             + [(200 + i, 0, "«idiot» idiot zzz") for i in range(2)])
    got = {r.prefix: (r.t, r.n, r.tu, r.nu) for r in X.prefix_counts(spark.createDataFrame(
        texts, "cluster long, toxic int, text string")).collect()}
    assert got["idiot\n"] == got["idi"] == (20, 17, 20, 2) and got["zzz"] == (20, 17, 20, 17)
    terms = X.choose_terms(got, 40, 100, len(got))
    assert ("idiot", True) in [t[:2] for t in terms] and "zzz" not in [t[0] for t in terms]


def test_every_significant_term_is_kept():
    r = np.random.Generator(np.random.PCG64(6))
    words = sorted({"".join(r.choice(list("abcdefghijklmnopqrst"), 6)) for _ in range(450)})
    counts = {w[:k]: (50, 0) for w in words for k in range(3, 7)}
    counts |= {w + X.END: (50, 0) for w in words}
    terms = X.choose_terms(counts, 1000, 1000, len(counts))
    edits = X.stem_edits(terms, counts)
    s = X.Scorer(terms, X.build_automata([t[:2] for t in terms], edits), X.letter_bits(),
                 np.zeros(4)).prepare()
    assert len(terms) > 2 * X.MAX_TERMS == 400 and len(s.automata) == 3
    for w in words:
        (term, e), = matched(s, w)
        assert w.startswith(term) and e == 0


def test_toxicity_learns_and_tells_quotation(spark):
    r = np.random.Generator(np.random.PCG64(3))
    vocab = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    bad = ["idiot", "moron", "worthless"]
    docs, labels = [], []
    for i in range(900):
        words = [vocab[k] for k in r.integers(0, len(vocab), 60)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(int(r.integers(0, 60)), bad[r.integers(0, 3)])
        docs.append((i, " ".join(words), 9, "l"))
        labels.append((i, int(toxic), 1))
    labels += [(None, 1, 1), (7, None, 1), (7, 0, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, toxic int, lid string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    scorer = X.fit(d, lab)
    assert {t for t, _, _ in scorer.terms} >= set(bad)
    got = X.score(d, scorer).collect()
    wrong = sum(x.predicted != (x.doc_id % 4 == 0) for x in got
                if zlib.crc32(str(x.doc_id).encode()) % 5 == 0)
    assert wrong == 0
    s = scorer.prepare()
    plain = " ".join(vocab[:40])

    def of(text):
        return s.scores(s.batch_features([text]))[0]
    assert of(f"{plain} you idiot, worthless moron") > 0.9
    assert of(f"{plain} you idiiot, wort*less mor0n") > of(plain)
    assert of(f'{plain} he said "idiot" and "moron"') < 0.5
    long = (plain + "\n") * 9000
    assert abs(of(long + "idiot") - s.scores(s.features(long + "idiot")[None])[0]) < 1e-12


def test_toxicity_odd_inputs(spark):
    df = odd(spark)
    labels = spark.createDataFrame([(5, 1)], "doc_id long, toxic int")
    for lab in (labels, labels.limit(0)):
        scorer = X.fit(df, lab)
        got = X.score(df, scorer).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if not r.text}) == 1
    assert X.score(df.limit(0), scorer).count() == 0


def test_held_out_of_null_ids(spark):
    assert [r[0] for r in odd(spark).select(held_out(X.F.col("doc_id"))).collect()][0] is False


def test_quotations_are_found_in_one_pass():
    def quoted(text):
        return [text[a + 1:b] for a, b in X.quotations(text).tolist()]
    assert quoted('a "b c" d "e"') == ["b c", "e"]
    assert quoted('a "b\nc" d') == [] and quoted("“a ‘b’ c” ‘d’ «e» „f“") == ["a ‘b’ c", "d", "e", "f"]
    assert quoted("‘you don’t say’ she’s") == ["you don’t say"]
    assert quoted('“open and "closed" here') == ["closed"] and quoted('‘a “b "c" «d') == ["c"]
    assert quoted("") == [] and quoted('"') == [] and quoted('"' * 100_001 + "x") != []
    r = random.Random(3)
    for _ in range(300):
        text = "".join(r.choice('ab "“”„«»‘’\n') for _ in range(r.randint(0, 40)))
        spans = X.quotations(text).tolist()
        assert all("\n" not in text[a:b] and text[b] in X.CLOSING[text[a]] for a, b in spans)
        assert all(p[1] < q[0] for p, q in zip(spans, spans[1:]))
    places = np.array([0, 3, 5, 9])
    assert X.inside(np.array([[2, 4], [5, 7]]), places).tolist() == [False, True, True, False]


@pytest.mark.parametrize("marks", ['""', "“”", "‘’", "«»"])
@pytest.mark.parametrize("size", [50, 2050, 300_000, 1_200_000])
def test_a_long_quotation_does_not_turn_its_line_around(marks, size):
    """An insult between two quotations is outright, whatever the length of the first."""
    a, b = marks
    filler = ("fine words " * (size // 11 + 1))[:size]
    text = f"{a}{filler}{b} then you are an idiot and she replied {a}idiot fine{b}"
    spans = X.quotations(text)
    first, second = text.index("idiot"), text.rindex("idiot")
    assert X.inside(spans, np.array([3, first, second])).tolist() == [True, False, True]
    assert X.Scorer.context(text, first, first + 5, False) >= 0.75
    assert X.Scorer.context(text, second, second + 5, True) <= X.QUOTED
