"""Toxicity scores: a learned lexicon trie met by Levenshtein automata, and context windows.

Fitting (on a bounded sample: at most ``SAMPLE_DOCS`` labelled texts per label, chosen by hash of
the id, outside the held-out fold):

1. *Lexicon.* All prefixes of the sample's words are counted by label, near copies (equal minimum
   hash of three-word sequences) as one text, once over the whole text and once outside quotation
   marks. Prefixes that by either count mark toxic texts beyond chance (log-likelihood against the
   number of prefixes tested) and at ``RATIO`` times the clean texts' rate form a trie, which is
   cut where a term ends (``idiot``) or where its continuations fan out (a stem such as ``xyz-``).
   All of them are kept with their log-odds weights.
2. *Automaton.* The trie is intersected with the Levenshtein automata of its terms (distance 0 to
   2 by length, edits at every character; a stem has the edits of the whole words it stands for)
   and determinised into one transition table over character classes for every ``MAX_TERMS`` terms;
   look-alike digits fold into letters.
3. *Doubt.* Words that match as misspellings but are in the sample's clean texts too (ordinary
   words near a term) get a lower weight, by their own log-odds.
4. *Weights.* A logistic regression on the document features below.

Scoring runs the table over all words of a batch at once: numpy steps one character position at a
time through the words still alive. Each match is then judged in its context window: inside
quotation marks or beside reporting words (``said``, ``the word``) it counts as quotation, beside
an address (``you``) as abuse. Features are the log-scaled sums of exact and of misspelled matches
and their density; quoted matches keep ``QUOTED`` of their weight.

The lexicon, the tables and the weights are broadcast; the sample bounds their size.
Words are runs of letters and digits, with single symbols (``@ * $ !``) inside; up to ``LEAD``
symbols before a word are read with and without it, and the reading with fewer edits counts.

Definitions: a null or empty text has no match and gets the base score. Equal texts get equal
scores. Without toxic labels in the sample there are no terms and the base score is the sample's
toxic share. Several labels of one id count as their maximum. Columns named like the results are
replaced; texts are worked off in slices of ``SLICE`` characters cut at line ends or spaces.
"""

from __future__ import annotations

import dataclasses
import math
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planscore.llm.sampling import bounded_sample, held_out
from planscore.session import materialize

SAMPLE_DOCS = 2000             # per label
SAMPLE_CHARS = 200_000         # code points of a sampled text that fitting reads (scoring: all)
MAX_TERMS = 200                # of one automaton; as many automata as the terms need
LONGEST = 12                   # characters of the prefixes counted
MIN_DOCS = 3                   # toxic texts that a term must occur in
RATIO = 10                     # a term's rate in toxic texts against that in clean ones
QUOTES = '"[^"\n]*"|“[^”\n]*”|«[^»\n]*»|„[^“\n]*“'
QUOTED = 0.02
AROUND = 48                    # characters of context on either side
SLICE = 1 << 20
FAN, FAN_SHARE = 3, 0.04       # so many continuations of that share make a stem
LEAD = 2                       # symbols before a word that may stand for its first letters
END = "\n"                     # closes a whole word in the prefix counts

# Cue words of the context windows.
REPORTING = ("said says saying called calling quote quoted quotes quoting wrote written word words "
             "term terms phrase means meaning slur example sagte sagt wort zitat dit mot terme "
             "cita palabra dijo").split()
ADDRESS = ("you your youre u ur du dich dein ihr euch tu toi vous te ton usted eres "
           "ustedes").split()
# Digits read as letters.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
# Opening quotation marks and the marks that close them.
CLOSING = {'"': '"', "“": "”", "„": "“”", "«": "»", "‘": "’"}
_MARKS = re.compile("[\"“”„«»‘’\\n]")
_REPORT = re.compile(r"\b(?:" + "|".join(REPORTING) + r")\b", re.I)
_ADDRESS = re.compile(r"\b(?:" + "|".join(ADDRESS) + r")\b", re.I)


def allowed(text: str, whole: bool) -> int:
    """Edits that a term allows."""
    n = len(text)
    return (0 if n < 4 else 1 if n < 8 else 2) if whole else (0 if n < 7 else 1)


@dataclasses.dataclass
class Automaton:
    """``step[state, class]`` with dead state 0; ``term``/``edits`` per state (-1: none);
    ``stem``: states reached when a stem is complete (they loop)."""

    chars: list
    step: np.ndarray
    term: np.ndarray
    edits: np.ndarray


def stem_edits(terms: list[tuple], counts: dict[str, tuple]) -> list[int]:
    """Edits per term (text, whole, ...): a stem allows those of the shortest whole word that it
    stands for."""
    shortest: dict[str, int] = {}
    stems = {t[0] for t in terms if not t[1]}
    for p in counts:
        if p.endswith(END):
            for k in range(3, len(p)):
                if p[:k] in stems:
                    shortest[p[:k]] = min(shortest.get(p[:k], len(p)), len(p) - 1)
    return [max(allowed(t[0], t[1]), 0 if t[1] else allowed("x" * shortest.get(t[0], 0), True))
            for t in terms]


def build_automaton(terms: list[tuple[str, bool]], edits: list[int] | None = None,
                    exact_first: bool = True, chars: list | None = None) -> Automaton:
    """Determinised product of the terms' trie and their Levenshtein automata, with the given
    edits per term (else those of its length); without ``exact_first`` the first character may be
    missing, wrong or one too many as any other. ``chars`` may hold more than the terms'."""
    chars = chars or sorted({c for t, _ in terms for c in t})
    child: list[dict] = [{}]
    reach = [0]                                    # most edits any term below allows
    ends: list[dict] = [{}]                        # whole? -> (term, allowed)
    for i, (text, whole) in enumerate(terms):
        most = edits[i] if edits else allowed(text, whole)
        node = 0
        for c in text:
            reach[node] = max(reach[node], most)
            if c not in child[node]:
                child[node][c] = len(child)
                child.append({})
                reach.append(0)
                ends.append({})
            node = child[node][c]
        reach[node] = max(reach[node], most)
        ends[node][whole] = (i, most)

    def closed(items: dict) -> frozenset:
        """Add the nodes reached by leaving characters of a term out."""
        todo = list(items.items())
        while todo:
            node, e = todo.pop()
            for nxt in child[node].values():
                if e + 1 <= reach[nxt] and items.get(nxt, 99) > e + 1:
                    items[nxt] = e + 1
                    todo.append((nxt, e + 1))
        return frozenset(items.items())

    def move(state: frozenset, c: str | None) -> frozenset:
        items: dict = {}

        def put(node, e):
            if e <= reach[node] and items.get(node, 99) > e:
                items[node] = e
        for node, e in state:
            put(node, e + 1)                       # a character too many
            if e + 1 <= reach[node]:
                for k, nxt in child[node].items():
                    put(nxt, e if k == c else e + 1)   # right or wrong character
            elif c in child[node]:
                put(child[node][c], e)
        return closed(items)

    def found(state: frozenset, whole: bool):
        hits = [(e, *ends[n][whole]) for n, e in state if whole in ends[n]]
        return min(((e, i) for e, i, most in hits if e <= most), default=None)

    number: dict = {(frozenset(), None): 0, "start": 1}
    table, term, cost = [[0] * (len(chars) + 1), None], [-1, -1], [0, 0]
    todo: list = []

    def state_of(state: frozenset, stem) -> int:
        """Number of the state; ``stem`` is the best stem met so far in the word. Once there is
        one, only items with fewer edits matter."""
        stem = min((x for x in (stem, found(state, False)) if x), default=None)
        if stem:
            state = frozenset(x for x in state if x[1] < stem[0])
        key = (state, stem)
        if key not in number:
            number[key] = len(table)
            table.append(None)
            hit = min((x for x in (stem, found(state, True)) if x), default=None)
            term.append(hit[1] if hit else -1)
            cost.append(hit[0] if hit else 0)
            todo.append(key)
        return number[key]

    def row_of(state: frozenset, stem) -> list[int]:
        row = [state_of(move(state, None), stem)] * (len(chars) + 1)
        for c in {c for node, _ in state for c in child[node]}:   # all others move alike
            row[place[c]] = state_of(move(state, c), stem)
        return row

    place = {c: i for i, c in enumerate(chars)}
    if exact_first:
        table[1] = [state_of(closed({child[0][c]: 0}), None) if c in child[0] else 0
                    for c in chars] + [0]
    else:
        table[1] = row_of(closed({0: 0}), None)
    while todo:
        key = todo.pop()
        table[number[key]] = row_of(*key)
    return Automaton(chars, np.array(table, np.int32), np.array(term), np.array(cost))


def build_automata(terms: list[tuple[str, bool]], edits: list[int]) -> list[Automaton]:
    """Automata of at most ``MAX_TERMS`` terms, over the characters of all terms; together they
    number the terms as given."""
    chars = sorted({c for t, _ in terms for c in t})
    out = []
    for i in range(0, len(terms), MAX_TERMS):
        a = build_automaton(terms[i:i + MAX_TERMS], edits[i:i + MAX_TERMS], False, chars)
        a.term[a.term >= 0] += i
        out.append(a)
    return out


def choose_terms(counts: dict[str, tuple], toxic: int, clean: int,
                 tested: int) -> list[tuple[str, bool, float]]:
    """(text, whole word, weight) from the prefix counts: toxic and clean texts, then, if given,
    those that have the prefix outside quotation marks."""
    if not toxic or not clean:
        return []
    base = toxic / (toxic + clean)

    def odds(p: str) -> float:
        c = counts[p]
        return max(math.log((t + 0.5) / (toxic + 1) / ((n + 0.5) / (clean + 1)))
                   for t, n in zip(c[::2], c[1::2]))

    def marks(t: int, n: int) -> bool:
        if t < MIN_DOCS:
            return False
        share = t / (t + n)
        gain = t * math.log(share / base) + (n * math.log((1 - share) / (1 - base)) if n else 0)
        return (share > base and RATIO * n * toxic <= t * clean
                and gain > math.log(10.0 * max(tested, 1)))

    def good(p: str) -> bool:
        c = counts[p]
        return any(marks(t, n) for t, n in zip(c[::2], c[1::2]))

    accepted = {p for p in counts if good(p)}
    follow: dict[str, list[str]] = {}
    for p in counts:
        follow.setdefault(p[:-1], []).append(p)
    out, todo = [], [p for p in accepted if p[:-1] not in accepted]
    while todo:
        p = todo.pop()
        below = [q for q in follow.get(p, []) if counts[q][0] >= FAN_SHARE * counts[p][0]]
        if p.endswith(END):
            out.append((p[:-1], True))
        elif below and len(below) < FAN and all(q in accepted for q in below):
            todo += below
        else:
            out.append((p, False))
    weights = {(x, w): odds(x + END * w) for x, w in out}
    best = max(weights.values(), default=1.0)
    return sorted((x, w, v / best) for (x, w), v in weights.items())


@dataclasses.dataclass
class Scorer:
    """The lexicon's automata, the fixed character tables and the regression weights."""

    terms: list
    automata: list
    letters: np.ndarray            # packed bits by code point: letter or digit
    weights: np.ndarray            # of the features, last the intercept
    trust: dict | None = None      # factors of misspelled matches, by form; others have 1

    def prepare(self) -> "Scorer":
        """Character tables, built once per task."""
        self.is_word = np.unpackbits(self.letters).astype(bool)
        self.inner = np.isin(np.arange(128), [ord(c) for c in "@*$!"])
        chars = self.automata[0].chars if self.automata else []
        self.cls = np.full(0x110000, len(chars), np.int16)
        for i, c in enumerate(chars):
            for x in {c, c.upper(), c.title()}:
                if len(x) == 1:
                    self.cls[ord(x)] = i
        for digit, c in LOOKALIKE.items():
            if c in chars and digit not in chars:
                self.cls[ord(digit)] = chars.index(c)
        return self

    def matches(self, text: str):
        """(start, end, term, edits) arrays of the words that match, and the number of words."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        word = self.is_word[code]
        low = code < 128
        sym = np.zeros(len(code), bool)
        sym[low] = self.inner[code[low]]
        led = sym.copy()
        if len(code) > 2 and sym.any():
            sym[1:-1] &= word[:-2] & word[2:]
            sym[0] = sym[-1] = False
            word = word | sym
        edge = np.diff(np.r_[False, word, False].astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        words = start
        if not self.automata or not len(start):
            return start[:0], end[:0], start[:0], start[:0], len(words), words
        # words behind symbols are read once more with each of them
        owner = lead = np.arange(len(start))
        for k in range(1, LEAD + 1):
            lead = lead[words[lead] >= k]
            lead = lead[led[words[lead] - k]]
            owner = np.r_[owner, lead]
            start, end = np.r_[start, words[lead] - k], np.r_[end, end[lead]]
        cls = self.cls[code]
        runs = [self._run(a, cls, start, end) for a in self.automata]
        w, term, edits = (np.concatenate(x) for x in zip(*runs))
        order = np.lexsort((term, w, edits, owner[w]))
        w, term, edits = w[order], term[order], edits[order]
        best = np.r_[True, np.diff(owner[w]) != 0][:len(w)]      # fewest edits of each word
        w = w[best]
        return start[w], end[w], term[best], edits[best], len(words), words

    @staticmethod
    def _run(a: Automaton, cls: np.ndarray, start: np.ndarray, end: np.ndarray):
        """(word, term, edits) of the words that the automaton accepts."""
        state = a.step[1, cls[start]]
        alive = np.flatnonzero(state)
        at, state = start[alive] + 1, state[alive]
        done_word, done_state = [alive[:0]], [state[:0]]
        while len(alive):
            over = at >= end[alive]
            done_word.append(alive[over])
            done_state.append(state[over])
            alive, at, state = alive[~over], at[~over], state[~over]
            state = a.step[state, cls[np.minimum(at, len(cls) - 1)]]
            go = state != 0
            alive, at, state = alive[go], at[go] + 1, state[go]
        w, s = np.concatenate(done_word), np.concatenate(done_state)
        hit = a.term[s] >= 0
        return w[hit], a.term[s[hit]], a.edits[s[hit]]

    def misspelled(self, text: str) -> set[tuple[str, int]]:
        """Forms of the text that match with edits, and their terms."""
        return {(self.form(part[s:e], t), t) for part in slices(text)
                for s, e, t, k in zip(*(x.tolist() for x in self.matches(part)[:4])) if k}

    def form(self, word: str, term: int) -> str:
        """The word, for a stem only as many characters of it, marked with a hyphen."""
        text, whole, _ = self.terms[term]
        return word.lower() if whole else word.lower()[:len(text)] + "-"

    def trusted(self, word: str, term: int) -> float:
        return self.trust.get(self.form(word, term), 1.0) if self.trust else 1.0

    @staticmethod
    def context(text: str, start: int, end: int, quoted: bool) -> float:
        """Weight of a match by its context window; ``quoted``: inside quotation marks."""
        line = text.rfind("\n", max(0, start - AROUND), start) + 1
        stop = text.find("\n", end, end + AROUND)
        before = text[max(line, start - AROUND):start]
        after = text[end:min(len(text), end + AROUND) if stop < 0 else stop]
        near = before + " \n " + after
        weight = QUOTED if quoted else 1.0
        if _REPORT.search(near):
            weight *= 0.5 if not quoted else 1.0
        if not quoted and _ADDRESS.search(near):
            weight *= 1.5
        return weight

    def features(self, text: str) -> np.ndarray:
        """Logs of: matches (misspelled ones count half), their density, misspelled matches.

        The last lets the regression move the worth of misspellings away from one half."""
        exact = fuzzy = 0.0
        words = at = 0
        spans = quotations(text)
        for part in slices(text):
            start, end, term, edits, n, _ = self.matches(part)
            words += n
            quoted = inside(spans, start + at)
            at += len(part)
            for s, e, t, k, q in zip(start.tolist(), end.tolist(), term.tolist(),
                                     edits.tolist(), quoted.tolist()):
                v = self.terms[t][2] * self.context(part, s, e, q)
                if k:
                    fuzzy += v * self.trusted(part[s:e], t) / (1 + k)
                else:
                    exact += v
        return self._row(exact, fuzzy, words)

    @staticmethod
    def _row(exact: float, fuzzy: float, words: int) -> np.ndarray:
        total = exact + 0.5 * fuzzy
        return np.array([math.log1p(total), math.log1p(100 * total / (words + 100)),
                         math.log1p(fuzzy)])

    def batch_features(self, texts: list[str]) -> np.ndarray:
        """Features of many texts: short ones are run through the automaton together."""
        out = np.zeros((len(texts), 3))
        out[:] = self._row(0.0, 0.0, 0)
        group, size = [], 0
        for i, x in enumerate(texts):
            if len(x) > SLICE // 4:
                out[i] = self.features(x)
            elif x:
                group.append(i)
                size += len(x) + 1
            if group and (size > SLICE or i == len(texts) - 1):
                self._grouped(texts, group, out)
                group, size = [], 0
        return out

    def _grouped(self, texts, group, out) -> None:
        joined = "\n".join([texts[i] for i in group])
        begins = np.cumsum([0] + [len(texts[i]) + 1 for i in group])
        start, end, term, edits, _, all_words = self.matches(joined)
        words = np.diff(np.searchsorted(all_words, begins))
        exact, fuzzy = np.zeros(len(group)), np.zeros(len(group))
        doc = np.searchsorted(begins, start, side="right") - 1
        quoted = inside(quotations(joined), start) if len(start) else np.zeros(0, bool)
        for d, s, e, t, k, q in zip(doc.tolist(), start.tolist(), end.tolist(), term.tolist(),
                                    edits.tolist(), quoted.tolist()):
            v = self.terms[t][2] * self.context(joined, s, e, q)
            if k:
                fuzzy[d] += v * self.trusted(joined[s:e], t) / (1 + k)
            else:
                exact[d] += v
        for j, i in enumerate(group):
            if exact[j] or fuzzy[j]:
                out[i] = self._row(exact[j], fuzzy[j], int(words[j]))

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = features @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def quotations(text: str) -> np.ndarray:
    """(start, end) of the quotations of a text, one after the other, from one pass over its marks.

    A quotation opens at a mark and closes at the next mark of its kind in the same line; one that
    the line does not close is none. Marks of other kinds inside a quotation count for nothing, and
    an apostrophe (a single closing mark before a letter or digit) closes none."""
    spans, line = [], []
    for m in _MARKS.finditer(text):
        if m.group() != "\n":
            line.append((m.start(), m.group()))
        elif line:
            spans += _line_quotations(text, line)
            line = []
    spans += _line_quotations(text, line)
    return np.array(spans, np.int64).reshape(-1, 2)


def _line_quotations(text: str, marks: list[tuple[int, str]]) -> list[tuple[int, int]]:
    spans, unclosed, i, opened = [], set(), 0, None
    while i < len(marks):
        at, mark = marks[i]
        if opened is None:
            if mark in CLOSING and mark not in unclosed:
                opened = i
        elif mark in CLOSING[marks[opened][1]] and not (
                mark == "’" and text[at + 1:at + 2].isalnum()):
            spans.append((marks[opened][0], at))
            opened = None
        i += 1
        if i == len(marks) and opened is not None:
            # nothing closes this kind any more: the marks after it are read once more without it
            unclosed.add(marks[opened][1])
            i, opened = opened + 1, None
    return spans


def inside(spans: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which places lie in one of the spans."""
    if not len(spans):
        return np.zeros(len(places), bool)
    k = np.searchsorted(spans[:, 0], places, "right") - 1
    return (k >= 0) & (places < spans[np.maximum(k, 0), 1])


def slices(text: str):
    """Pieces of about ``SLICE`` characters cut at a line end, else a space, else anywhere."""
    at = 0
    while len(text) - at > SLICE:
        cut = text.rfind("\n", at + SLICE // 2, at + SLICE)
        cut = text.rfind(" ", at + SLICE // 2, at + SLICE) if cut < 0 else cut
        cut = at + SLICE if cut < 0 else cut + 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def letter_bits() -> np.ndarray:
    return np.packbits(np.array([chr(i).isalnum() for i in range(0x110000)], bool))


def regress(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2,
            steps: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton steps (intercept last, not penalised)."""
    a = np.c_[x, np.ones(len(x))]
    pen = np.r_[np.full(x.shape[1], ridge * len(x) ** 0.5), 1e-6]
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + pen * w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(pen + 1e-9)
        move = np.linalg.solve(hess, grad)
        w -= move * min(1.0, 5 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-8:
            break
    return w


def cluster_of(text: Column) -> Column:
    """Smallest hash of the text's three-word sequences: nearly always one value for near copies,
    so that a copied text counts as one piece of evidence."""
    def smallest(w: Column) -> Column:
        return F.array_min(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 2, F.lit(1))),
                                       lambda i: F.xxhash64(F.slice(w, i, 3))))
    return F.transform(F.array(F.split(F.lower(text), r"\s+")), smallest).getItem(0)


def prefix_counts(sample: DataFrame) -> DataFrame:
    """``prefix, t, n, tu, nu`` (toxic and clean clusters that contain it, then those that contain
    it outside quotation marks) over ``text, toxic, cluster``."""
    def words(text: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0)))
    w = F.col("w")
    prefixes = F.transform(F.sequence(F.lit(3), F.greatest(F.lit(3), F.least(
        F.length(w), F.lit(LONGEST)))), lambda k: F.substr(w, F.lit(1), k))
    plain = words(F.regexp_replace("text", QUOTES, " "))
    seen = (sample.select("cluster", "toxic", plain.alias("plain"), words(F.col("text")).alias("a"))
            .select("cluster", "toxic", "plain", F.explode("a").alias("w"))
            .select("cluster", "toxic", "w",
                    F.array_contains("plain", w).cast("int").alias("plain"))
            .groupBy("cluster", "toxic", "w").agg(F.max("plain").alias("plain"))
            .filter("length(w) >= 3")
            .select("cluster", "toxic", "plain", F.explode(F.concat(
                prefixes, F.array(F.concat(w, F.lit(END))))).alias("prefix"))
            .groupBy("cluster", "toxic", "prefix").agg(F.max("plain").alias("plain")))
    bad, good = F.col("toxic"), 1 - F.col("toxic")
    return seen.groupBy("prefix").agg(*[F.sum(x).cast("long").alias(c) for c, x in [
        ("t", bad), ("n", good), ("tu", bad * F.col("plain")), ("nu", good * F.col("plain"))]])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", docs_per_label: int = SAMPLE_DOCS) -> Scorer:
    """Lexicon, automaton and weights from a bounded sample of the labelled texts."""
    known = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("lid"))
             .agg(F.max((F.col(label_col) == 1).cast("int")).alias("toxic")))
    share = {r.toxic: r.n for r in known.filter(~held_out(F.col("lid"))).groupBy("toxic")
             .agg(F.count("*").alias("n")).collect()}                     # two rows
    ids = bounded_sample(known, "toxic", "lid", docs_per_label)
    # docs_per_label ids per label; several rows of one id all count
    texts = docs.select(F.col(id_col).alias("id"), F.substring(
        F.coalesce(F.col(text_col), F.lit("")), 1, SAMPLE_CHARS).alias("text"))
    sample = texts.join(F.broadcast(ids), F.col("id") == F.col("lid")).select(
        "id", "toxic", "text")
    sample = materialize(sample.withColumn("cluster", cluster_of(F.col("text"))),
                         "toxicity-sample")
    toxic, clean = sample.agg(
        F.count_distinct(F.when(F.col("toxic") == 1, F.col("cluster"))),
        F.count_distinct(F.when(F.col("toxic") == 0, F.col("cluster")))).first()
    counts = materialize(prefix_counts(sample).filter(F.col("t") >= MIN_DOCS), "prefix-counts")
    # prefixes of the bounded sample
    rows = (counts.filter(f"{RATIO} * n * {toxic} <= t * {clean} or "
                          f"(tu >= {MIN_DOCS} and {RATIO} * nu * {toxic} <= tu * {clean})")
            .orderBy("prefix").collect())
    seen = {r.prefix: (r.t, r.n, r.tu, r.nu) for r in rows}
    terms = choose_terms(seen, toxic, clean, counts.count())
    scorer = Scorer(terms, build_automata([(x, w) for x, w, _ in terms], stem_edits(terms, seen)),
                    letter_bits(), np.zeros(4))
    total = sum(share.values())
    prior = share.get(1, 0) / total if total else 0.0
    if not terms:
        scorer.weights[-1] = math.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
        return scorer
    scorer.trust = trust_of(sample, scorer, toxic, clean, [seen[x + END * w] for x, w, _ in terms])
    got = (sample.repartition("id").select("id", "text", "toxic")
           .mapInArrow(_features_of(sample, scorer), "toxic int, f array<double>")).collect()
    got = sorted((r.toxic, tuple(r.f)) for r in got)          # docs_per_label rows per label
    y = np.array([t for t, _ in got], float)
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9),
                      (1 - prior) / max(1 - y.mean(), 1e-9))
    scorer.weights = regress(np.array([f for _, f in got]), y, weight)
    return scorer


def _packed(scorer: Scorer) -> dict:
    return {**vars(scorer), "automata": [vars(a) for a in scorer.automata]}


def _unpacked(packed: dict) -> Scorer:
    return Scorer(packed["terms"], [Automaton(**a) for a in packed["automata"]],
                  packed["letters"], packed["weights"], packed["trust"]).prepare()


def trust_of(sample: DataFrame, scorer: Scorer, toxic: int, clean: int,
             exact: list[tuple]) -> dict[str, float]:
    """Per form that clean texts of the sample have and that matches with edits: its log-odds as a
    share (0 to 1) of those of the term (``exact``: toxic and clean clusters per term)."""
    shared = sample.sparkSession.sparkContext.broadcast(_packed(scorer))

    def run(batches):
        model = _unpacked(shared.value)
        for b in batches:
            rows = [(y, c, *wt) for x, y, c in zip(*(b.column(i).to_pylist() for i in range(3)))
                    for wt in sorted(model.misspelled(x or ""))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
                    (pa.int32(), pa.int64(), pa.string(), pa.int32()))],
                names=["toxic", "cluster", "word", "term"])
    once = F.count_distinct(F.when(F.col("toxic") == 1, F.col("cluster"))).alias("t")
    seen = (sample.select("text", "toxic", "cluster")
            .mapInArrow(run, "toxic int, cluster long, word string, term int")
            .groupBy("word", "term")
            .agg(once, F.count_distinct(F.when(F.col("toxic") == 0, F.col("cluster"))).alias("n"))
            .filter("n > 0").orderBy("word", "term").collect())   # of the bounded sample

    def odds(t: int, c: int) -> float:
        return math.log((t + 0.5) / (toxic + 1) / ((c + 0.5) / (clean + 1)))
    return {r.word: min(1.0, max(0.0, odds(r.t, r.n) / max(odds(*exact[r.term][:2]), 1e-9)))
            for r in seen}


def _features_of(df: DataFrame, scorer: Scorer):
    shared = df.sparkSession.sparkContext.broadcast(_packed(scorer))

    def run(batches):
        model = _unpacked(shared.value)
        for b in batches:
            f = model.batch_features([x.as_py() or "" for x in b.column(1)])
            yield pa.RecordBatch.from_arrays(
                [b.column(2), pa.array(list(f), pa.list_(pa.float64()))], names=["toxic", "f"])
    return run


def score(df: DataFrame, scorer: Scorer, text_col: str = "text") -> DataFrame:
    """Adds ``score`` and ``predicted``."""
    keep = [c for c in df.columns if c not in ("score", "predicted")]
    src = df.select(*[df[c] for c in keep])
    shared = df.sparkSession.sparkContext.broadcast(_packed(scorer))
    at = keep.index(text_col)

    def run(batches):
        model = _unpacked(shared.value)
        for b in batches:
            p = model.scores(model.batch_features([x.as_py() or "" for x in b.column(at)]))
            yield pa.RecordBatch.from_arrays(
                b.columns + [pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=keep + ["score", "predicted"])
    schema = T.StructType([*src.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return src.mapInArrow(run, schema)


def op4(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every text of ``documents``, learned from ``labels``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scorer = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, scorer).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
