"""Language identification with a byte convolutional network.

The network sees fixed-length windows of UTF-8 bytes (A-Z lower-cased, zero-padded): filters of
several widths over byte embeddings, max pooling over the window, one dense softmax layer. An
embedding followed by a filter tap is a table of 256 rows, so the convolution is a sum of shifted
table look-ups. It is trained in numpy with Adam on a bounded sample of labelled texts
(``SAMPLE_DOCS`` texts per language with ``SAMPLE_WINDOWS`` windows each, chosen by hash of the
id); the driver receives only these windows. The weights (some 20,000 numbers) are broadcast.

Prediction covers every byte of every text: windows overlap by the largest filter width less one,
so each filter position falls into one window; window probabilities are averaged by the number of
bytes. Windows are worked off in blocks of ``BLOCK`` whatever the length of the texts.

A text is *familiar* if enough of its runs of ``GRAM`` letter or space bytes occur in the sample of
any label: ``SLACK`` times what nearly all sample windows reach against the other half of the sample,
less what a text of its length may miss by chance. So text in one or several learned languages is
familiar, gibberish and other languages are not, whatever the number of labels.

Definitions: a null text or one without a letter (Unicode category L) is ``und`` with score 0.
Equal texts get equal predictions. Without labelled rows everything is ``und``. With one label
everything with a letter gets it, score 1. Columns named like the results are replaced.
"""

from __future__ import annotations

import dataclasses
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planscore.llm.sampling import bounded_sample, held_out, text_bytes

WIDTHS = (2, 3, 4)
FILTERS = 8                    # per width
WINDOW = 256                   # bytes
STEP = WINDOW - max(WIDTHS) + 1
BLOCK = 128                    # windows at once
SAMPLE_DOCS = 300              # per language
SAMPLE_WINDOWS = 4             # per text
EPOCHS, BATCH, RATE, DECAY = 14, 64, 0.02, 1e-4
UNKNOWN = "und"
GRAM, GRAM_BITS = 4, 22
SLACK, NEARLY_ALL = 0.7, 0.05

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TEXTUAL = np.zeros(256, bool)                               # letters, other scripts, space
_TEXTUAL[97:123] = _TEXTUAL[128:] = _TEXTUAL[32] = True


@dataclasses.dataclass
class ByteCnn:
    """``taps[i]``: (width, FILTERS, 256) look-up tables of the i-th width."""

    labels: list
    taps: list
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    grams: np.ndarray | None = None                          # packed bits by hash: seen
    least: float = 0.0                                       # share of a familiar text

    def pooled(self, windows: np.ndarray, places: bool = False):
        """Max-pooled filter outputs, one row per window (and the places of the maxima)."""
        n, best, at = len(windows), [], []
        for tap in self.taps:
            width = len(tap)
            span = WINDOW - width + 1
            seen = np.take(tap, windows, axis=2)             # width, filter, window, place
            out = seen[0, :, :, :span].copy()
            for k in range(1, width):
                out += seen[k, :, :, k:k + span]
            if places:
                at.append(out.argmax(axis=2))
                best.append(np.take_along_axis(out, at[-1][:, :, None], 2)[:, :, 0])
            else:
                best.append(out.max(axis=2))
        pooled = np.concatenate(best).T + self.bias
        return (pooled, np.concatenate(at).T.reshape(n, -1)) if places else pooled

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.pooled(windows), 0)
        logits = hidden @ self.dense + self.dense_bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: list, seed: int = 7) -> ByteCnn:
    """Fit the network to byte windows (n x WINDOW, zero-padded) and their labels."""
    names = sorted(set(labels))
    y = np.array([names.index(x) for x in labels])
    rng = np.random.Generator(np.random.PCG64(seed))
    hidden = FILTERS * len(WIDTHS)
    net = ByteCnn(
        names, [rng.normal(0, 0.3, (w, FILTERS, 256)).astype(np.float32) for w in WIDTHS],
        np.zeros(hidden, np.float32),
        rng.normal(0, 0.3, (hidden, len(names))).astype(np.float32),
        np.zeros(len(names), np.float32))
    for tap in net.taps:
        tap[:, :, 0] = 0                                     # padding
    params = [*net.taps, net.bias, net.dense, net.dense_bias]
    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]
    step = 0
    share = np.bincount(y, minlength=len(names)) / len(y)
    weight = (1 / (len(names) * share))[y].astype(np.float32)
    for epoch in range(EPOCHS if len(names) > 1 else 0):
        order = rng.permutation(len(y))
        lr = RATE * (1 - epoch / EPOCHS)
        for a in range(0, len(y), BATCH):
            pick = order[a:a + BATCH]
            x, t, n = windows[pick], y[pick], len(pick)
            pre, at = net.pooled(x, places=True)
            act = np.maximum(pre, 0)
            logits = act @ net.dense + net.dense_bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), t] -= 1
            p *= (weight[pick] / n)[:, None]
            back = (p @ net.dense.T) * (pre > 0)
            grads = []
            for i, w in enumerate(WIDTHS):
                g = np.zeros((w, FILTERS, 256), np.float32)
                own = slice(i * FILTERS, (i + 1) * FILTERS)
                for k in range(w):
                    byte = np.take_along_axis(x, at[:, own] + k, axis=1)
                    np.add.at(g[k], (np.arange(FILTERS)[None, :], byte), back[:, own])
                g[:, :, 0] = 0
                grads.append(g)
            grads += [back.sum(axis=0), act.T @ p, p.sum(axis=0)]
            step += 1
            for q, g, mi, vi in zip(params, grads, m, v):
                g = g + DECAY * q
                mi += 0.1 * (g - mi)
                vi += 0.001 * (g * g - vi)
                q -= lr * (mi / (1 - 0.9 ** step)) / (np.sqrt(vi / (1 - 0.999 ** step)) + 1e-8)
    return net


def padded(raw: bytes) -> np.ndarray:
    out = np.zeros(WINDOW, np.uint8)
    part = np.frombuffer(raw[:WINDOW], np.uint8)
    out[:len(part)] = _LOWER[part]
    return out


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``GRAM`` letter or space bytes."""
    low = _LOWER[raw]
    n = max(0, len(low) - GRAM + 1)
    code, good = np.zeros(n, np.uint32), np.ones(n, bool)
    for k in range(GRAM):
        code = code << np.uint32(8) | low[k:k + n]
        good &= _TEXTUAL[low[k:k + n]]
    return (code[good] * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS)


def gram_table(cuts) -> np.ndarray:
    seen = np.zeros(1 << GRAM_BITS, bool)
    for c in cuts:
        seen[gram_hashes(np.frombuffer(c.encode(), np.uint8))] = True
    return seen


def least_share(halves: list[list[str]]) -> float:
    """Share of seen grams that a familiar text has: each half of the sample meets the other's."""
    shares = []
    for cuts, other in (halves, halves[::-1]):
        seen = gram_table(other)
        got = [seen[gram_hashes(np.frombuffer(c.encode(), np.uint8))] for c in cuts]
        shares += [x.mean() for x in got if len(x) >= WINDOW // 4]
    return SLACK * float(np.quantile(shares, NEARLY_ALL)) if shares else 0.0


def familiar_column(net: ByteCnn, seen: np.ndarray, column) -> np.ndarray:
    """Whether the texts of an Arrow column are familiar; worked off in blocks."""
    data, offsets = text_bytes(column)
    out = np.ones(len(offsets) - 1, bool)
    for i in range(len(out)):
        n = known = 0
        for a in range(int(offsets[i]), int(offsets[i + 1]), 1 << 20):
            h = gram_hashes(data[a:min(a + (1 << 20) + GRAM - 1, int(offsets[i + 1]))])
            n, known = n + len(h), known + int(seen[h].sum())
        out[i] = n == 0 or known / n + n ** -0.5 >= net.least
    return out


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        docs_per_label: int = SAMPLE_DOCS) -> ByteCnn | None:
    """Train on a bounded sample of the labelled rows outside the held-out fold."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                     F.col(label_col).alias("label"))
    ids = bounded_sample(rows.select("id", "label"), "label", "id", docs_per_label)
    text = F.coalesce("text", F.lit(""))
    # windows at hashed places of the whole text
    starts = F.transform(F.sequence(F.lit(1), F.lit(SAMPLE_WINDOWS)), lambda i: F.pmod(
        F.xxhash64("id", i), F.greatest(F.length(text) - WINDOW // 2, F.lit(1))) + 1)
    cuts = F.array_distinct(F.transform(starts, lambda s: F.substr(
        text, s.cast("int"), F.lit(WINDOW))))
    picked = (rows.filter(F.col("label").isNotNull() & ~held_out(F.col("id")))
              .join(F.broadcast(ids.select("id")),           # docs_per_label rows per label
                    "id", "left_semi")
              .select("label", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(2)).alias("half"),
                      F.explode(cuts).alias("cut")))
    got = [r for r in picked.distinct().collect() if r.cut]
    known = sorted({(r.label, r.cut) for r in got})
    if not known:
        return None
    net = train(np.stack([padded(c.encode()) for _, c in known]), [x for x, _ in known])
    net.grams = np.packbits(gram_table(c for _, c in known))
    net.least = least_share([[r.cut for r in got if r.half == h] for h in (0, 1)])
    return net


def predict_column(net: ByteCnn, column) -> tuple[np.ndarray, np.ndarray]:
    """Index of the likeliest label and its probability, per text of an Arrow column."""
    data, offsets = text_bytes(column)
    length = np.diff(offsets)
    count = np.maximum(1, -(-(length - (WINDOW - STEP)) // STEP))
    first = np.r_[0, np.cumsum(count)]
    total = np.zeros((len(length), len(net.labels)))
    for a in range(0, int(first[-1]), BLOCK):
        w = np.arange(a, min(a + BLOCK, int(first[-1])))
        doc = np.searchsorted(first, w, side="right") - 1
        start = offsets[doc] + (w - first[doc]) * STEP
        place = start[:, None] + np.arange(WINDOW)
        inside = place < offsets[doc + 1][:, None]
        x = np.zeros(place.shape, np.uint8)
        x[inside] = _LOWER[data[place[inside]]]
        p = net.probabilities(x) * inside.sum(axis=1, keepdims=True)
        np.add.at(total, doc, p)
    total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-300)
    return total.argmax(axis=1), total.max(axis=1)


def identify(df: DataFrame, net: ByteCnn | None, text_col: str = "text",
             pred_col: str = "lang_pred", score_col: str = "score",
             familiar_col: str | None = None) -> DataFrame:
    """Adds the prediction and its score and, if named, whether the text is familiar."""
    added = [pred_col, score_col] + ([familiar_col] if familiar_col else [])
    keep = [c for c in df.columns if c not in added]
    shared = df.sparkSession.sparkContext.broadcast(net and vars(net))
    at = keep.index(text_col)

    def run(batches):
        import regex
        letter = regex.compile(r"\p{L}")
        model = shared.value and ByteCnn(**shared.value)
        seen = np.unpackbits(model.grams).astype(bool) if familiar_col and model else None
        for b in batches:
            texts = b.column(at)
            known = np.array([bool(letter.search(x.as_py() or "")) for x in texts], bool)
            name = np.full(len(texts), UNKNOWN, object)
            score = np.zeros(len(texts))
            if model is not None and known.any():
                best, p = predict_column(model, texts)
                name[known] = np.array(model.labels, object)[best[known]]
                score[known] = np.minimum(p[known], 1.0)
            more = []
            if familiar_col:
                more = [pa.array(np.zeros(len(texts), bool) if seen is None
                                 else familiar_column(model, seen, texts))]
            yield pa.RecordBatch.from_arrays(
                b.columns + [pa.array(name, pa.string()), pa.array(score)] + more,
                names=keep + added)
    schema = df.select(*[df[c] for c in keep]).schema.add(pred_col, "string").add(
        score_col, "double")
    if familiar_col:
        schema = schema.add(familiar_col, "boolean")
    return df.select(*[df[c] for c in keep]).mapInArrow(run, schema)


def op1(spark, sf_dir: str) -> DataFrame:
    """Language of every text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred",
                      "score")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
