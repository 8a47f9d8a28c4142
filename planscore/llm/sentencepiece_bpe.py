"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The distinct words of a batch of texts are laid end to end in flat numpy arrays of symbols. In
each round the pair ranks of every word are reduced to the word's smallest (segmented minimum),
all pairs of that rank merge at once, leftmost first where they overlap, the arrays are compacted,
and words without a mergeable pair leave. Rounds go on until none is left. Word results are kept
in a bounded cache per task; texts are put together from them. Nothing is trained and the
sentencepiece library is not called for encoding or decoding: the driver reads the model file once
and broadcasts its tables, whose size is that of the vocabulary.

Exactness. The library merges one pair at a time, best score first, then leftmost. Merging all
equal pairs of a word at once gives the same result unless the merged piece can at once combine
into a piece of the same or a better rank; for such pieces (found from the vocabulary) only the
leftmost pair of a word merges per round. Words are units because no piece has the space mark
after another character (checked); words are cut further between two characters that no piece
holds next to each other. Pieces of space marks alone rank last (checked) and are laid over each
run of bare marks from the left afterwards. Characters without a piece become byte pieces.

Definitions: null text counts as empty, which has no ids and decodes to the empty text. A literal
U+2581 is a space mark, as in the library. Texts of any length are worked off in blocks cut at
single spaces. Columns of the result replace input columns of the same name; others pass through.
"""

from __future__ import annotations

import dataclasses
import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
NONE = np.int32(2 ** 31 - 1)
CACHE_WORDS = 200_000          # words a task keeps; beyond it the cache starts anew
BLOCK_CHARS = 1 << 20          # texts are cut into blocks of about this length
NEW_CHARS = 1 << 20            # characters of new words that are encoded at once


@dataclasses.dataclass
class Tables:
    """Everything the tasks need, as arrays. Pairs are keyed ``left * size + right``."""

    size: int
    char_id: np.ndarray        # by code point; -1 without a piece
    byte_id: np.ndarray
    pair_key: np.ndarray       # sorted
    pair_piece: np.ndarray
    rank: np.ndarray           # by piece
    careful: np.ndarray        # by piece: merge leftmost only
    bigram: np.ndarray         # sorted; adjacent characters inside pieces
    run: list                  # by number of bare marks: lengths of the pieces laid over them
    mark_id: dict              # by length: piece of that many space marks
    surface: list              # by piece: bytes that it decodes to


def load_tables(path: str) -> Tables:
    """Read a SentencePiece BPE model (byte fallback, identity normaliser, dummy prefix)."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    kind, norm = pb.ModelProto.SentencePiece, model.normalizer_spec
    if (model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback
            or norm.precompiled_charsmap or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix or not norm.escape_whitespaces
            or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces)):
        raise ValueError("only BPE models with byte fallback, identity normalisation and no "
                         "user-defined or unused pieces are supported")
    size = len(model.pieces)
    ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
    score = {p: model.pieces[i].score for p, i in ids.items()}
    runs = {p for p in ids if len(p) > 1 and not p.strip(MARK)}
    words = [p for p in ids if p not in runs]
    if (any(MARK in p[1:] for p in words)
            or runs and max(score[p] for p in runs) >= min(score[p] for p in words if p[1:])
            or {c for p in words for c in p} - ids.keys()):
        raise ValueError("vocabulary whose pieces cross spaces or lack their characters")
    level = {s: i for i, s in enumerate(sorted({score[p] for p in words}, reverse=True))}
    rank = np.full(size, NONE, np.int32)
    careful = np.zeros(size, bool)
    pairs = []
    for p in words:
        rank[ids[p]] = level[score[p]]
    for p in words:
        for k in range(1, len(p)):
            a, b = ids.get(p[:k]), ids.get(p[k:])
            if a is not None and rank[a] >= rank[ids[p]]:
                careful[a] = True
            if b is not None and rank[b] >= rank[ids[p]]:
                careful[b] = True
            if a is not None and b is not None:
                pairs.append((a * size + b, ids[p]))
    pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    char_id = np.full(0x110000, -1, np.int32)
    for p in words:
        if len(p) == 1:
            char_id[ord(p)] = ids[p]
    byte_id = np.zeros(256, np.int32)
    surface = [b""] * size
    for i, p in enumerate(model.pieces):
        if p.type == kind.BYTE:
            byte_id[int(p.piece[3:5], 16)] = i
            surface[i] = bytes([int(p.piece[3:5], 16)])
        elif p.type == kind.NORMAL:
            surface[i] = p.piece.replace(MARK, " ").encode()
        elif p.type == kind.UNKNOWN:
            surface[i] = " ⁇ ".encode()
    bigram = np.unique(np.array([ord(a) * 0x110000 + ord(b) for p in words
                                 for a, b in zip(p, p[1:])], np.int64))
    mark_id = {len(p): ids[p] for p in runs | {MARK}}
    longest = max(mark_id)
    run = [lay_marks(n, set(mark_id)) for n in range(2 * longest)]
    if any(run[n] != [longest] + run[n - longest] for n in range(longest, 2 * longest)):
        raise ValueError("runs of space marks that do not start with the longest piece")
    return Tables(size, char_id, byte_id, pairs[:, 0].copy(), pairs[:, 1].astype(np.int32), rank,
                  careful, bigram, run[:longest], mark_id, surface)


def lay_marks(n: int, lengths: set[int]) -> list[int]:
    """Piece lengths of a run of ``n`` bare marks: the leftmost pair that makes a piece merges
    first (all of them rank the same)."""
    parts = [1] * n
    while True:
        at = next((i for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in lengths), None)
        if at is None:
            return parts
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


def _pieces_of(t: Tables, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Piece that each pair merges to, -1 without one."""
    key = left.astype(np.int64) * t.size + right
    key[(left < 0) | (right < 0)] = -1
    at = np.minimum(np.searchsorted(t.pair_key, key), len(t.pair_key) - 1)
    return np.where(t.pair_key[at] == key, t.pair_piece[at], -1).astype(np.int32)


def merge_rounds(t: Tables, sym: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge until no pair remains. ``unit``: non-decreasing unit number of each symbol. Returns
    the symbols and units left, in order."""
    piece = np.full(len(sym), -1, np.int32)      # of the pair that starts here
    if len(sym) > 1:
        same = unit[:-1] == unit[1:]
        piece[:-1] = np.where(same, _pieces_of(t, sym[:-1], sym[1:]), -1)
    done_sym, done_unit = [], []
    while len(sym):
        rank = np.where(piece >= 0, t.rank[piece], NONE)
        start = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        length = np.diff(np.r_[start, len(sym)])
        least = np.minimum.reduceat(rank, start)             # segmented minimum
        live = np.repeat(least < NONE, length)
        if not live.all():                                   # finished words leave
            done_sym.append(sym[~live])
            done_unit.append(unit[~live])
            if not live.any():
                break
            sym, unit, piece, rank = sym[live], unit[live], piece[live], rank[live]
            length, least = length[least < NONE], least[least < NONE]
        here = rank == np.repeat(least, length)
        at = np.flatnonzero(here)
        # leftmost of overlapping pairs: every other one of a run of neighbours in a word
        first = np.r_[True, (np.diff(at) > 1) | (unit[at[1:]] != unit[at[:-1]])]
        run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        take = (np.arange(len(at)) - run) % 2 == 0
        risky = t.careful[piece[at]]
        if risky.any():                                      # leftmost pair of the word only
            head = np.r_[True, unit[at[1:]] != unit[at[:-1]]]
            word = np.cumsum(head) - 1
            risky_word = np.zeros(word[-1] + 1, bool)
            risky_word[word[risky]] = True
            take &= head | ~risky_word[word]
        at = at[take]
        sym[at] = piece[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        new_at = np.cumsum(keep)[at] - 1                     # place after compaction
        sym, unit, piece = sym[keep], unit[keep], piece[keep]
        for k in (new_at, new_at - 1):                       # pairs that a merge has changed
            k = k[k >= 0]
            k = k[k < len(sym) - 1] if len(k) and k[-1] >= len(sym) - 1 else k
            fresh = _pieces_of(t, sym[k], sym[k + 1])
            piece[k] = np.where(unit[k] == unit[k + 1], fresh, -1)
        piece[-1] = -1
    if not done_sym:
        return sym, unit
    all_sym, all_unit = np.concatenate(done_sym), np.concatenate(done_unit)
    order = np.argsort(all_unit, kind="stable")
    return all_sym[order], all_unit[order]


def encode_words(t: Tables, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, each with its leading space mark, end to end; and where each ends."""
    text = MARK + MARK.join(words)
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    # words hold no mark, so each mark starts a word
    begins = code == ord(MARK)
    pair = code[:-1] * 0x110000 + code[1:]
    found = np.minimum(np.searchsorted(t.bigram, pair), len(t.bigram) - 1)
    cut = begins.copy()
    cut[1:] |= t.bigram[found] != pair
    sym = t.char_id[code].copy()
    unknown = sym < 0
    sym[unknown] = -2 - code[unknown]
    unit = np.cumsum(cut) - 1
    word_of_unit = (np.cumsum(begins) - 1)[cut]
    sym, unit = merge_rounds(t, sym, unit)
    word = word_of_unit[unit]
    bad = np.flatnonzero(sym < 0)
    if len(bad):                                             # byte fallback
        raw = [chr(-2 - int(s)).encode() for s in sym[bad]]
        times = np.ones(len(sym), np.int64)
        times[bad] = [len(r) for r in raw]
        out, word = np.repeat(sym, times), np.repeat(word, times)
        out[np.repeat(sym < 0, times)] = t.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        sym = out
    ends = np.searchsorted(word, np.arange(len(words)), side="right")
    return sym.astype(np.int32), ends


def decode_ids(t: Tables, ids) -> str:
    """Text of a sequence of ids: surfaces joined, one leading space taken off, bytes that are
    not UTF-8 replaced."""
    raw = b"".join([t.surface[i] for i in ids])
    return raw.decode("utf-8", "replace").removeprefix(" ")


class Encoder:
    """Encodes texts word by word with a bounded cache. An entry holds the ids as text, as int32
    bytes, the decoded bytes, the number of ids, and whether the space mark stayed alone."""

    def __init__(self, tables: Tables):
        self.t, self.cache = tables, {}
        self.names = [str(i) for i in range(tables.size)]

    def learn(self, words: set[str]) -> None:
        missing = [w for w in words if w not in self.cache]
        if len(self.cache) + len(missing) > CACHE_WORDS:
            self.cache = {}
            missing = list(words)
        bare, chunk, chars = self.t.mark_id[1], [], 0
        for k, w in enumerate(missing):
            chunk.append(w)
            chars += len(w) + 1
            if chars >= NEW_CHARS or k == len(missing) - 1:
                flat, ends = encode_words(self.t, chunk)
                ids, raw, a = flat.tolist(), flat.tobytes(), 0
                names = [self.names[i] for i in ids]
                surface = [self.t.surface[i] for i in ids]
                for word, b in zip(chunk, ends.tolist()):
                    self.cache[word] = (",".join(names[a:b]), raw[4 * a:4 * b],
                                        b"".join(surface[a:b]), b - a, ids[a] == bare)
                    a = b
                chunk, chars = [], 0

    def entries(self, words: list[str]) -> list[tuple]:
        """One entry per word; runs of bare space marks joined into run pieces."""
        found = [self.cache[w] for w in words]
        if "" not in words:
            return found
        out, run = [], 0
        for w, e in zip(words, found):
            if w == "":
                run += 1
                continue
            if run and e[4]:                                 # the word's own mark joins the run
                out += self._run(run + 1)
                rest = np.frombuffer(e[1], np.int32)[1:]
                if len(rest):
                    out.append((e[0].split(",", 1)[1], rest.tobytes(), e[2][1:], e[3] - 1, False))
            else:
                out += self._run(run)
                out.append(e)
            run = 0
        return out + self._run(run)

    def _run(self, n: int) -> list[tuple]:
        longest = len(self.t.run)
        pieces = [longest] * (n // longest) + self.t.run[n % longest]
        return [(str(self.t.mark_id[k]), np.int32(self.t.mark_id[k]).tobytes(), b" " * k, 1,
                 False) for k in pieces]


def blocks(text: str, size: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """Words of the text (split at single spaces or marks), in blocks cut at a space between two
    other characters, so that no run of spaces is parted."""
    text = text.replace(MARK, " ")
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        while cut >= 0 and (text[cut - 1] == " " or text[cut + 1:cut + 2] in (" ", "")):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut].split(" ")
        at = cut + 1
    yield text[at:].split(" ")


def encoded(enc: Encoder, texts: list[str]) -> Iterator[Iterator[list[tuple]]]:
    """Per text its blocks of entries. The words of consecutive texts are learnt together, up to
    ``BLOCK_CHARS`` characters; a longer text goes block by block."""
    def one_by_one(text: str) -> Iterator[list[tuple]]:
        for words in blocks(text):
            enc.learn(set(words))
            yield enc.entries(words)

    at = 0
    while at < len(texts):
        group, chars = [], 0
        while at + len(group) < len(texts) and chars + len(texts[at + len(group)]) <= BLOCK_CHARS:
            text = texts[at + len(group)]
            group.append(next(blocks(text)) if text else [])
            chars += len(text)
        if not group:
            yield one_by_one(texts[at])
            at += 1
            continue
        enc.learn(set().union(*group))
        for words in group:
            yield iter([enc.entries(words)] if words else [])
        at += len(group)


def _digests(parts: Iterator[list[tuple]]) -> tuple[int, str, str]:
    ids, out, n, sep, lead = hashlib.sha256(), hashlib.sha256(), 0, "", " "
    for found in parts:
        ids.update((sep + ",".join([e[0] for e in found])).encode())
        raw = b"".join([e[2] for e in found])
        # blocks are cut before a space mark, never inside a character
        out.update(raw.decode("utf-8", "replace").removeprefix(lead).encode())
        n += sum([e[3] for e in found])
        sep, lead = ",", ""
    return n, ids.hexdigest(), out.hexdigest()


def _with_columns(df: DataFrame, fields: list[T.StructField], text_col: str, tables, make):
    """``df`` plus the fields that ``make(encoder, texts)`` returns as Arrow arrays."""
    names = {f.name for f in fields}
    src = df.select(*[df[c] for c in df.columns if c not in names or c == text_col])
    keep = [c for c in df.columns if c not in names]
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    shared = df.sparkSession.sparkContext.broadcast(vars(tables))

    def run(batches):
        enc = Encoder(Tables(**shared.value))
        for b in batches:
            texts = [x.as_py() or "" for x in b.column(src_names.index(text_col))]
            made = make(enc, texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(src_names.index(c)) for c in keep] + made,
                names=keep + [f.name for f in fields])
    src_names = src.columns
    return src.mapInArrow(run, schema)


def encode_digests(df: DataFrame, tables: Tables, text_col: str = "text") -> DataFrame:
    """Adds ``n_tokens``, ``ids_sha256`` (decimal ids, comma-joined) and ``decoded_sha256``."""
    def make(enc, texts):
        rows = [_digests(x) for x in encoded(enc, texts)]
        return [pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.string()),
                pa.array([r[2] for r in rows], pa.string())]
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    return _with_columns(df, fields, text_col, tables, make)


def encode_decode(df: DataFrame, tables: Tables, text_col: str = "text") -> DataFrame:
    """Adds ``n_tokens``, ``token_ids`` and ``decoded``, the text that the ids decode to."""
    def make(enc, texts):
        sizes, flat, back = [], [], []
        for parts in encoded(enc, texts):
            found = [e for block in parts for e in block]
            raw = b"".join([e[1] for e in found])
            sizes.append(len(raw) // 4)
            flat.append(raw)
            back.append(b"".join([e[2] for e in found]).decode("utf-8", "replace")
                        .removeprefix(" "))
        ids = np.frombuffer(b"".join(flat), np.int32)
        offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
        return [pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                pa.array(back, pa.string())]
    fields = [T.StructField("n_tokens", T.LongType()),
              T.StructField("token_ids", T.ArrayType(T.IntegerType())),
              T.StructField("decoded", T.StringType())]
    return _with_columns(df, fields, text_col, tables, make)


def decode_texts(df: DataFrame, tables: Tables, ids_col: str = "token_ids",
                 out_col: str = "decoded") -> DataFrame:
    """Adds the text that the ids decode to (null or no ids: the empty text)."""
    def make(enc, lists):
        return [pa.array([decode_ids(enc.t, x or ()) for x in lists], pa.string())]
    return _with_columns(df, [T.StructField(out_col, T.StringType())], ids_col, tables, make)


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op7(spark, sf_dir: str, model: str | None = None) -> DataFrame:
    """``documents`` encoded and decoded, as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return (encode_digests(docs, load_tables(model or default_model()))
            .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
