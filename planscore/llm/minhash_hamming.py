"""Near-duplicate linking: b-bit MinHash signatures and a multi-index Hamming join.

1. Every text becomes its set of word shingles (64-bit hashes, vectorised over byte buffers), and
   a signature of ``CHUNKS * LANES`` MinHash values of 16 bits, kept as ``CHUNKS`` long integers.
   Texts with equal sets (128-bit digest) are one class; only classes go on.
2. Multi-index: by the pigeonhole principle two signatures that differ in at most
   ``CHUNKS * (ERRORS + 1) - 1`` lanes have a chunk with at most ``ERRORS`` differing lanes. Each
   chunk is entered under every key that masks out ``ERRORS`` of its lanes, so that such pairs
   meet under an equal key: all pairs under the signature distance threshold are found. (At
   similarity 0.8 a pair has no such chunk with probability 1e-6; pairs beyond the guaranteed
   distance that meet anyway are followed up to ``FOLLOW`` lanes.)
3. Pairs under a key are followed in two steps, so that a group of n copies costs n pairs and not
   n^2: first every class against the key's smallest class; then, once those links have been
   confirmed and joined into components, the pairs of different components that are left. Both
   steps test the signature distance and set sizes before any set is moved. The second step also
   bounds the symmetric difference from below: each bit in which two classes' bitmaps of hashed
   shingles differ stands for a shingle that only one of them has. That bound drops no link and
   refutes most pairs of a large family of edited copies without a look at the sets.
4. Links are confirmed on full shingle sets (``100 * intersection >= percent * union``), and
   components come from alternating large-star / small-star rounds on the confirmed links.

No link between different components is lost: every pair under a common key is either tested or
already connected. Keys, links and labels stay distributed; joins are equi-joins that AQE can
split; written tables in the shared folder cut the lineage.

Definitions: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A text with fewer words than
a shingle has its whole word sequence as the only shingle; without words, or null, the set is
empty and linked with nothing. Rows with equal sets are linked. Rows that share a document id
are one document each; the smallest id of a component names it. An empty table gives an empty
result. Columns named like the results are replaced by them.
"""

from __future__ import annotations

import hashlib
import itertools
import sys
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planscore.llm.sampling import text_bytes
from planscore.session import materialize

CHUNKS, LANES, ERRORS = 8, 4, 1
FOLLOW = 20
BLOCK = 1 << 21                # bytes hashed at once
SHINGLES = 1 << 18             # shingles signed at once
SIG = [f"c{i}" for i in range(CHUNKS)]
MAP_WORDS = 32                 # 64-bit words of the shingle bitmaps

_random = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _random.integers(0, 2 ** 64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _random.integers(0, 2 ** 64, 64, np.uint64) | np.uint64(1)
_MUL = _random.integers(0, 2 ** 64, CHUNKS * LANES, np.uint64) | np.uint64(1)
_ADD = _random.integers(0, 2 ** 64, CHUNKS * LANES, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE)], dtype=np.uint64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in a buffer of texts (``offsets``: where each text starts, and the
    end), and the number of words before each offset. Works in blocks of about ``BLOCK`` bytes
    cut at white space or between texts."""
    hashes, starts_at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    at, end = int(offsets[0]), int(offsets[-1])
    bounds = np.unique(offsets)
    while at < end:
        stop = min(at + BLOCK, end)
        # extend to a white byte or the next text's start
        nxt = int(bounds[np.searchsorted(bounds, stop)])
        step = 1 << 16
        while stop < nxt:
            ahead = data[stop:min(stop + step, nxt)]
            white = np.flatnonzero((ahead == 32) | ((ahead >= 9) & (ahead <= 13)))
            if len(white):
                stop += int(white[0])
                break
            stop += len(ahead)
        b = data[at:stop]
        b = np.where((b >= 65) & (b <= 90), b | 32, b)
        word = ~((b == 32) | ((b >= 9) & (b <= 13)))
        begin = word.copy()
        begin[1:] &= ~word[:-1]
        inner = bounds[np.searchsorted(bounds, at):np.searchsorted(bounds, stop)] - at
        begin[inner] = word[inner]
        first = np.flatnonzero(begin)
        if len(first):
            index = np.arange(len(b))
            place = np.where(word, index - np.maximum.accumulate(np.where(begin, index, 0)), 0)
            powers = _powers(int(place.max()))
            value = np.where(word, _BYTE[b] * powers[place], np.uint64(0))
            hashes.append(_mix(np.add.reduceat(value, first)))
            starts_at.append(first + at)
        at = stop
    places = np.concatenate(starts_at)
    return np.concatenate(hashes), np.searchsorted(places, offsets)


def shingle_sets(words: np.ndarray, before: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    n = len(words) - k + 1
    if n > 0:
        rolled = sum((words[j:n + j] * _PLACE[j] for j in range(k)), np.zeros(n, np.uint64))
        rolled = _mix(rolled)
    out = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(rolled[a:b - k + 1]))
        elif b > a:
            # short texts: the whole sequence, told apart by its length
            out.append(_mix((words[a:b] * _PLACE[:b - a]).sum(dtype=np.uint64, keepdims=True)
                            + _PLACE[k + b - a]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signature of each non-empty set: one row of ``CHUNKS`` long integers; zeros for
    empty sets. Works in groups of about ``SHINGLES`` hashes; larger sets in slices."""
    sig = np.zeros((len(sets), CHUNKS * LANES), np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    group, size = [], 0
    for pos, i in enumerate(full):
        group.append(i)
        size += len(sets[i])
        if size >= SHINGLES or pos == len(full) - 1:
            flat = np.concatenate([sets[g] for g in group])
            starts = np.cumsum([0] + [len(sets[g]) for g in group[:-1]])
            for j in range(CHUNKS * LANES):
                sig[group, j] = np.minimum.reduceat(flat * _MUL[j] + _ADD[j], starts)
            group, size = [], 0
    lanes = (_mix(sig) >> np.uint64(48)).astype(np.uint16)
    lanes[[i for i, s in enumerate(sets) if not len(s)]] = 0
    return np.ascontiguousarray(lanes).view(np.int64)


def _batches_of(column, k: int):
    """(first row, shingle sets) of slices of the column of about ``4 * BLOCK`` bytes."""
    data, offsets = text_bytes(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + 4 * BLOCK, side="right")) - 1
        end = min(max(end, row + 1), n)
        words, before = word_hashes(data, offsets[row:end + 1])
        yield row, shingle_sets(words, before, k)
        row = end


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def signature_table(df: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Per row: ``id, n_shingles, cls`` (digest of the set; null if empty), ``nid`` (its first
    64 bits), ``h`` (hash of the text) and the signature."""
    def run(batches):
        for b in batches:
            for row, sets in _batches_of(b.column(1), k):
                sig, n = signatures(sets), len(sets)
                cls = [_digest(s) if len(s) else None for s in sets]
                nid = [int.from_bytes(c[:8], "little", signed=True) if c else None for c in cls]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(row, n), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(cls, pa.binary()), pa.array(nid, pa.int64()),
                     b.column(2).slice(row, n)]
                    + [pa.array(sig[:, i]) for i in range(CHUNKS)],
                    names=["id", "n_shingles", "cls", "nid", "h"] + SIG)
    kind = df.schema[id_col].dataType.simpleString()
    schema = (f"id {kind}, n_shingles long, cls binary, nid long, h long, "
              + ", ".join(f"{c} long" for c in SIG))
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                     F.xxhash64(text_col).alias("h")).mapInArrow(run, schema)


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``MAP_WORDS`` long integers per set: bit ``h % bits`` for each shingle hash."""
    out = np.zeros((len(sets), MAP_WORDS * 64), np.uint8)
    for i, s in enumerate(sets):
        out[i, s % np.uint64(MAP_WORDS * 64)] = 1
    return np.packbits(out, axis=1).view(np.int64)


def set_table(df: DataFrame, k: int) -> DataFrame:
    """``id, text, cls`` -> ``cls, members`` (the shingle set) and its bitmap, for rows whose set
    is ``cls``."""
    def run(batches):
        for b in batches:
            want = b.column(2).to_pylist()
            for row, sets in _batches_of(b.column(1), k):
                good = [i for i, s in enumerate(sets) if _digest(s) == want[row + i]]
                bits = bitmaps([sets[i] for i in good])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([want[row + i] for i in good], pa.binary()),
                     pa.array([sets[i].view(np.int64) for i in good], pa.list_(pa.int64())),
                     pa.array(list(bits), pa.list_(pa.int64()))], names=["cls", "members", "map"])
    return df.select("id", "text", "cls").mapInArrow(
        run, "cls binary, members array<long>, map array<long>")


def index_keys() -> Column:
    """(slot, chunk, key) of a signature: each chunk with one of its lanes masked out; the slot
    numbers chunk and lane."""
    keys, lane = [], (1 << 64 // LANES) - 1
    for i, chunk in enumerate(SIG):
        for m, gone in enumerate(itertools.combinations(range(LANES), ERRORS)):
            mask = ~sum(lane << (16 * g) for g in gone) & (2 ** 64 - 1)
            mask -= (mask >> 63) << 64
            slot = F.lit(i * LANES + m)
            keys.append(F.struct(slot.alias("slot"), F.col(chunk).alias("chunk"), F.xxhash64(
                slot, F.col(chunk).bitwiseAND(F.lit(mask))).alias("key")))
    return F.array(*keys)


def lanes_apart(a: str, b: str, chunk: str) -> Column:
    """Number of lanes of a chunk in which two signatures (column prefixes) differ."""
    x = F.col(f"{a}.{chunk}").bitwiseXOR(F.col(f"{b}.{chunk}"))
    for s in (8, 4, 2, 1):
        x = x.bitwiseOR(F.shiftrightunsigned(x, s))
    return F.bit_count(x.bitwiseAND(F.lit(0x0001000100010001)))


def distance(a: str, b: str) -> Column:
    return reduce(lambda p, q: p + q, [lanes_apart(a, b, c) for c in SIG])


def first_meeting(a: str, b: str) -> Column:
    """True at one of the keys under which a pair meets: the first chunk with at most one
    differing lane, and there the masked lane if one differs, else the first lane."""
    slot = F.col(f"{a}.slot")
    first = reduce(lambda rest, ic: F.when(lanes_apart(a, b, ic[1]) <= ERRORS, ic[0]).otherwise(
        rest), reversed(list(enumerate(SIG))), F.lit(CHUNKS))
    return (((lanes_apart(a, b, "chunk") == ERRORS) | (slot % LANES == 0))
            & (first == F.floor(slot / LANES)))


def alike(a: str, b: str, percent: int) -> Column:
    """Cheap necessary conditions: set sizes and signature distance."""
    na, nb = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return ((F.least(na, nb) * 100 >= F.greatest(na, nb) * percent)
            & (distance(a, b) <= FOLLOW))


def near_enough(a: str, b: str, percent: int) -> Column:
    """Necessary condition on the bitmaps: with at least ``d`` shingles in only one of two sets
    of sizes m and n, the similarity is at most ``(m + n - d) / (m + n + d)``."""
    d = F.aggregate(F.zip_with(f"{a}.map", f"{b}.map", lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                    F.lit(0), lambda s, v: s + v)
    both = F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")
    return 100 * both - percent * both >= (100 + percent) * d


def sets_of(classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Shingle sets of classes (``cls, rep``), read again from their representative's text."""
    used = classes.select("cls", F.col("rep").alias("rep_id"))
    texts = docs.join(used.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("rep_id")))
    return materialize(set_table(texts, k), "shingle-sets")


def members_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a, b``: classes) that meet the threshold on full sets."""
    both = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("members").alias("sa")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("members").alias("sb")), "b")
            .select("a", "b", F.size("sa").cast("long").alias("na"),
                    F.size("sb").cast("long").alias("nb"),
                    F.size(F.array_intersect("sa", "sb")).cast("long").alias("both")))
    return both.filter(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both"))
                       * percent).select("a", "b")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` links -> ``cls, label`` (smallest member of the component), for linked classes.

    Alternates large-star and small-star until the links no longer change."""
    e = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a != b").distinct(), "links")
    state = _state(e)
    while state[0]:
        sym = e.union(e.select(F.col("b"), F.col("a")))
        # minima are written, so that AQE can split the links of a hub in the join
        low = materialize(sym.groupBy("a").agg(F.min("b").alias("m"))
                          .withColumn("m", F.least("a", "m")), "minima")
        large = materialize(sym.join(low, "a").filter("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "minima")
        pairs = large.join(low, "a")
        small = (pairs.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        e = materialize(small, "links")
        now = _state(e)
        if now == state:
            break
        state = now
    labels = e.select(F.col("a").alias("cls"), F.col("b").alias("label"))
    return labels.union(e.select(F.col("b").alias("cls"), F.col("b").alias("label")).distinct())


def link_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                   percent: int = 80) -> DataFrame:
    """Per row: ``id, n_shingles, component_id, kept``."""
    return _linked(df, id_col, text_col, k, percent).select(
        "id", "n_shingles", "component_id", "kept")


def _linked(df: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """:func:`link_documents` with ``cls``, ``h`` and the component's ``label``."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = materialize(signature_table(df, id_col, text_col, k), "signatures")
    full = rows.filter("cls is not null")
    # equal classes have equal signatures, sizes and nids: min picks that one value
    classes = materialize(full.groupBy("cls").agg(
        F.min("id").alias("rep"), *[F.min(c).alias(c) for c in ["n_shingles", "nid", *SIG]]),
        "classes")
    entries = (classes.select("nid", F.explode(index_keys()).alias("e"))
               .select("nid", "e.slot", "e.chunk", "e.key"))
    shared = (entries.groupBy("key").agg(F.min("nid").alias("hub"), F.count("*").alias("n"))
              .filter("n > 1"))
    shared = materialize(shared.select("key", "hub"), "shared-keys")   # AQE can split hot keys
    met = materialize(entries.join(shared, "key"), "met")
    sides = classes.select("cls", "nid", "n_shingles", *SIG)

    # step 1: every class against the smallest class of its keys
    ids = met.filter("nid != hub").select(F.col("nid").alias("p"), F.col("hub").alias("q"))
    stars = materialize(
        ids.distinct().join(sides.alias("x"), F.col("p") == F.col("x.nid"))
        .join(sides.alias("y"), F.col("q") == F.col("y.nid"))
        .filter(alike("x", "y", percent) & (F.col("x.cls") != F.col("y.cls")))
        .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")), "star-pairs")
    sets = sets_of(classes.join(met.select("nid").distinct(), "nid", "left_semi"), docs, k)
    links = materialize(confirmed(stars, sets.select("cls", "members"), percent), "star-links")
    labels = components(links)

    # step 2: pairs under a key whose classes are still in different components
    labelled = (classes.join(sets.select("cls", "map"), "cls").join(labels, "cls", "left")
                .select("cls", "nid", "n_shingles", *SIG, "map",
                        F.coalesce("label", "cls").alias("label")))
    labelled = materialize(labelled, "labelled")
    open_keys = (met.join(labelled.select("nid", "label"), "nid").groupBy("key")
                 .agg(F.min("label").alias("l1"), F.max("label").alias("l2"))
                 .filter("l1 != l2").select("key"))
    open_keys = materialize(open_keys, "open-key-list")
    left = materialize(met.select("key", "slot", "chunk", "nid").join(open_keys, "key", "left_semi")
                       .join(labelled, "nid"), "open-keys")
    x, y = left.alias("x"), left.alias("y")
    rest = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.cls") < F.col("y.cls"))
                   & (F.col("x.label") != F.col("y.label")) & first_meeting("x", "y")
                   & alike("x", "y", percent) & near_enough("x", "y", percent))
            .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct())
    tested = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = materialize(rest.join(tested, ["a", "b"], "left_anti"), "rest-pairs")
    if not rest.isEmpty():
        more = materialize(confirmed(rest, sets.select("cls", "members"), percent), "rest-links")
        labels = components(links.union(more))
    named = classes.select("cls", "rep").join(labels, "cls", "left").withColumn(
        "label", F.coalesce("label", "cls"))
    ids = materialize(named.groupBy("label").agg(F.min("rep").alias("component_id")),
                      "component-ids")
    by_class = named.join(ids, "label").select("cls", "component_id", "label")
    out = rows.select("id", "n_shingles", "cls", "h").join(by_class, "cls", "left")
    comp = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "n_shingles", comp.alias("component_id"),
                      F.col("id").eqNullSafe(comp).alias("kept"), "cls", "h", "label")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
             percent: int = 80) -> DataFrame:
    """One row of ``df`` per component (all its columns): of the rows that share the id which names
    it, the one with the smallest set digest and text hash. Rows without shingles are compared by
    id and text."""
    kept = _linked(df, id_col, text_col, k, percent).filter("kept")
    alone = F.when(F.col("cls").isNull(), F.struct("id", "h"))
    rows = (kept.groupBy("label", alone.alias("alone"), "id", "cls", "h")
            .agg(F.count("*").alias("n")))
    best = materialize(rows.groupBy("label", "alone").agg(
        F.min(F.struct("cls", "h", "id", "n")).alias("b"))
        .select(F.col("b.id").alias("_kept_id"), F.col("b.h").alias("_kept_h"),
                F.col("b.n").alias("_kept_n")), "kept-rows")

    def of(some: DataFrame) -> DataFrame:
        return df.join(some.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col("_kept_id"))
                       & (F.xxhash64(text_col) == F.col("_kept_h")), "left_semi")
    repeated = best.filter("_kept_n > 1")
    if repeated.isEmpty():
        return of(best)
    # rows repeated exactly: one of them
    return of(best.filter("_kept_n = 1")).union(
        df.join(repeated.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col("_kept_id"))
                & (F.xxhash64(text_col) == F.col("_kept_h")))
        .dropDuplicates(["_kept_id", "_kept_h"]).select(*[df[c] for c in df.columns]))


def op9(spark, sf_dir: str) -> DataFrame:
    """``documents`` linked at 80 % of distinct four-word shingles."""
    out = link_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4, percent=80)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
