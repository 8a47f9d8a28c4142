"""Best-fit packing of token sequences by hierarchical residual packing.

1. *Pieces.* Every text becomes its token ids and one closing id. Only documents longer than the
   capacity are cut, into pieces of exactly the capacity; the first piece takes the rest.
2. *Local round.* Each partition packs its own pieces, largest first, each into the open bin with
   the smallest gap that holds it (best fit).
3. *Tree rounds.* Nearly full bins are emitted. The others go on, whole, as items: the residues of
   ``fanin`` neighbouring groups meet, are packed by best fit again, and so on up the tree.

A bin counts as nearly full in round *r* when its gap is at most ``2**r / 64`` of the capacity, half
of it at most. After any best-fit round at most one bin of a group is half full or less, as two such
bins would have been one; so from round 5 on a group passes on one bin, and before that at most
``fanin**4`` partitions' residues meet. No task holds more than that, whatever the number of
documents. Only ids and lengths of bins travel in the tree rounds; pieces are written once, and learn
their final place by one join.

Token ids come from the ``tokenizers`` library, for each distinct blank-separated chunk of a block of
texts once; all its places get them in one numpy step. A chunk starts at a blank that has no other white space beside it, where the tokenizer
starts a new unit in any case (the byte-level pattern takes no blank after another character); texts
in which white space meets a blank are cut at the other blanks only. Chunks of Latin letters, signs
and digits are cut further into parts that are units by that pattern, so that the library's merges run
on each distinct word once. Known chunks and parts are kept in a bounded cache that
the tasks of a Python worker share.

Definitions: null text counts as empty and has the closing id alone. Ids, null ones too, pass through
unchanged; rows repeated exactly are packed each. Ties (equal lengths, equal gaps) go to the row
that comes first in its partition. Texts may have any length. An empty table gives an empty result.
Columns other than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import os
import re
import sys
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planscore.session import materialize

CAPACITY = 2048
CLOSING_ID = 0
FANIN = 8
LOCAL_PIECES = 1_000_000       # pieces that a task packs at once; beyond it a new local block starts
CACHE_CHUNKS = 600_000         # chunks a worker keeps; beyond it the cache starts anew
CACHE_CHARS = 48               # longer chunks are encoded each time
BATCH_ROWS = 8192              # rows whose texts a task holds as strings, at most
BLOCK_CHARS = 1 << 23          # characters of texts that are encoded together
JOIN_CHARS, JOIN_BATCH = 4096, 64   # unseen chunks are encoded joined, this much at once
SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")
# Parts of a chunk that the byte-level pattern tells apart whatever stands beside them: runs of Latin
# letters, runs of ASCII signs and digits but the apostrophe (contractions), single line ends. A text
# with ``OTHER`` characters, or ``LOOSE`` blanks and line ends beside each other, has others too.
LETTERS, SIGNS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-@\[-`{-~"
OTHER, LOOSE = re.compile(rf"[^{LETTERS}{SIGNS}\n ]"), re.compile(r"[\n ](?=[\n ]|\Z)")
PARTS = re.compile(rf" ?[{LETTERS}]+| ?[{SIGNS}]+|\n")


def _byte_letters() -> np.ndarray:
    """The code point by which a byte-level vocabulary spells each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = np.zeros(256, "<u4")
    out[plain] = plain
    out[out == 0] = 256 + np.arange(256 - len(plain))
    return out


BYTE_LETTERS = _byte_letters()
BYTE_LETTERS[ord("\n")] = ord("\n")        # ends of lines tell the words apart


def spelled(words: list[str]) -> str:
    """Words as the vocabulary spells them, one a line."""
    raw = np.frombuffer("\n".join(words).encode(), np.uint8)
    return BYTE_LETTERS[raw].tobytes().decode("utf-32-le")


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, tokenizer_json: str):
        # a task has one core; threads of the library's own would each hold memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers
        self.library = tokenizers.Tokenizer.from_str(tokenizer_json)
        # the same merges for words whose bytes are already spelled as the vocabulary spells them
        self.merges = tokenizers.Tokenizer(self.library.model)
        self.merges.pre_tokenizer = tokenizers.pre_tokenizers.WhitespaceSplit()
        self._forget()
        self.parts: dict[str, bytes] = {}             # words and other parts of chunks
        added = self.library.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        if self.library.normalizer is not None or any(
                re.search(r"\s", t.content) or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError("texts are cut at blanks, which this tokenizer does not allow")
        # a byte-level vocabulary spells each byte as one character; special tokens stand as they are
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.id_bytes = np.zeros(1 + max(vocab.values()), np.int64)
        for token, i in vocab.items():
            self.id_bytes[i] = len(token.encode()) if i in added else len(token)

    def _forget(self) -> None:
        """Start the cache of chunks (without their blank) anew: a chunk met for the first time gets
        the next number, its ids go there in ``ids`` (None: no safe place to cut)."""
        self.known: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.ids: list[bytes | None] = []
        self.at_work = False

    def _batch(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, items: list[str], library, spell) -> list[bytes]:
        """Ids of items that the tokenizer tells apart: texts of about ``JOIN_CHARS`` that ``spell``
        makes of many items are encoded, and their ids dealt back by the bytes that each stands for."""
        out, n = [], max(1, len(items) * JOIN_CHARS // max(1, sum(map(len, items))))
        blocks = [items[i:i + n] for i in range(0, len(items), n)]
        for at in range(0, len(blocks), JOIN_BATCH):
            group = blocks[at:at + JOIN_BATCH]
            got = library.encode_batch_fast([spell(x) for x in group], add_special_tokens=False)
            for block, encoding in zip(group, got):
                ids = np.array(encoding.ids, np.int64)
                ends = np.cumsum([len(x.encode()) for x in block])
                cuts = np.searchsorted(np.cumsum(self.id_bytes[ids]), ends, "right") * 4
                raw, cuts = ids.astype("<u4").tobytes(), cuts.tolist()
                out += [raw[i:j] for i, j in zip([0, *cuts], cuts)]
        return out

    def _simple(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that consist of parts, cut from one run over them all."""
        parts, pieces = self.parts, PARTS.findall(" " + " ".join(chunks))
        new = set(pieces).difference(parts)
        words = [x for x in new if x[-1].isalpha()]
        parts.update(zip(words, self._joined(words, self.merges, spelled)))
        signs = list(new.difference(words))
        parts.update(zip(signs, self._batch(signs)))
        got = list(map(parts.__getitem__, pieces))
        ends = np.cumsum(np.fromiter(map(len, got), np.int64, len(got)))
        # a part with a blank starts a chunk
        starts = np.array([i for i, x in enumerate(pieces) if x[0] == " "], np.int64)
        cuts = [*(ends[starts[1:] - 1]).tolist(), int(ends[-1])] if chunks else []
        raw = b"".join(got)
        return [raw[i:j] for i, j in zip([0, *cuts], cuts)]

    def _learn(self, chunks: list[str]) -> list[bytes | None]:
        """Ids of chunks, each with the blank before it."""
        def odd(text: str) -> bool:
            return OTHER.search(text) is not None or LOOSE.search(text) is not None
        if not odd(" " + " ".join(chunks)):
            return self._simple(chunks)
        other = {c for c in chunks if odd(" " + c)}
        simple = [c for c in chunks if c not in other]
        # a blank beside other white space is no safe place to cut
        safe = [c for c in other if c and not c[0].isspace() and not c[-1].isspace()]
        ids = dict(zip(simple, self._simple(simple)))
        ids.update(zip(safe, self._joined([" " + c for c in safe], self.library, "".join)))
        return [ids.get(c) for c in chunks]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text, the ids that the library gives for it."""
        out, block, size = [], [], 0
        for t in texts:
            if block and size + len(t) > BLOCK_CHARS:
                out += self._encode_block(block)
                block, size = [], 0
            block.append(t)
            size += len(t)
        return out + self._encode_block(block)

    def _encode_block(self, texts: list[str]) -> list[bytes]:
        if self.at_work or len(self.ids) > CACHE_CHUNKS:       # a block that failed left half an entry
            self._forget()
        if len(self.parts) > CACHE_CHUNKS:
            self.parts = {}
        self.at_work = True
        known, ids = self.known, self.ids
        special = np.array([any([x in t for x in self.special]) for t in texts], bool)
        split = pc.split_pattern(pa.array(["" if x else t for x, t in zip(special, texts)],
                                          pa.large_string()), " ")
        ends = split.offsets.to_numpy().astype(np.int64)
        chunks = split.values
        heads = chunks.take(pa.array(ends[:-1])).to_pylist()
        # every chunk of the block once, and where each stands; the head of a text is none
        coded = chunks.filter(pa.array(~np.isin(np.arange(len(chunks)), ends[:-1]))) \
            .dictionary_encode()
        place, ends = coded.indices.to_numpy(), ends - np.arange(len(ends))
        before = len(known)
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = list(map(known.__getitem__, distinct))
        new = list(itertools.islice(reversed(known), len(known) - before))[::-1]
        ids += self._learn(new)
        got = list(map(ids.__getitem__, numbers))
        unsafe = np.array([x is None for x in got], bool)
        broken = np.diff(np.concatenate([[0], np.cumsum(unsafe[place])])[ends]) > 0
        rest = _dealt([x or b"" for x in got], place, ends)
        first = []
        for i, (text, head) in enumerate(zip(texts, heads)):
            if special[i]:
                first.append([text])
            elif ends[i] < ends[i + 1] and (broken[i] or not head or head[-1].isspace()):
                first.append(SAFE_CUT.split(text))
                rest[i] = b""
            else:
                first.append([head])
        flat = iter(self._batch([c for x in first for c in x]))
        starts = [b"".join([next(flat) for _ in x]) for x in first]
        for c in [c for c in new if len(c) > CACHE_CHARS]:
            ids[known.pop(c)] = b""
        self.at_work = False
        return [h + r for h, r in zip(starts, rest)]


def _dealt(ids: list[bytes], place: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """``ids`` of the chunks ``place`` names, joined by text: those of text i stand from ``ends[i]``
    to ``ends[i + 1]``."""
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    raw = np.frombuffer(b"".join(ids), "<u4")
    length = size[place]
    until = np.concatenate([[0], np.cumsum(length)])
    shift = (np.cumsum(size) - size)[place] - until[:-1]
    out = raw[np.repeat(shift, length) + np.arange(until[-1])].tobytes()
    cuts = (until[ends] * 4).tolist()
    return [out[i:j] for i, j in zip(cuts, cuts[1:])]


class Shared:
    """A tokenizer's file, broadcast. A Python worker keeps a broadcast value as long as it lives, so
    its tasks share one encoder and what it has learnt."""

    def __init__(self, tokenizer_json: str):
        self.tokenizer_json, self.made = tokenizer_json, None

    def encoder(self) -> Encoder:
        if self.made is None:
            self.made = Encoder(self.tokenizer_json)
        return self.made


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing. Per item: its bin (the number of the bin's first item), its offset in
    the bin, and the final fill of that bin. Ties go to the earlier item."""
    n = len(sizes)
    home, offset = np.arange(n), np.zeros(n, np.int64)
    gap = np.zeros(n, np.int64)                 # by bin
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]     # by gap
    gaps = 0                                    # bit g: an open bin of gap g
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = gaps >> size
        if fits:
            g = size + (fits & -fits).bit_length() - 1
            b = open_bins[g].pop()
            if not open_bins[g]:
                gaps ^= 1 << g
            home[i], offset[i] = b, capacity - g
        else:
            b, g = i, capacity
        g -= size
        gap[b] = g
        if g:
            open_bins[g].append(b)
            gaps |= 1 << g
    return home, offset, capacity - gap[home]


def least_fill(level: int, capacity: int) -> int:
    """Fill from which a bin counts as nearly full in a round."""
    return capacity - min(capacity // 2, (capacity << level) // 64)


def _cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    if n_tokens <= capacity:
        return [(0, n_tokens)]
    rest = n_tokens % capacity
    return ([(0, rest)] if rest else []) + [
        (s, capacity) for s in range(rest, n_tokens, capacity)]


def local_round(df: DataFrame, id_col: str, text_col: str, tokenizer_json: str, capacity: int,
                payload: str, closing_id: int) -> DataFrame:
    """Pieces of every text, packed inside each partition: ``id, piece, start, length, payload, grp,
    bin, offset, fill``. ``payload`` is ``ids`` (array of the piece's token ids) or ``crc`` (unsigned
    CRC-32 of them as little-endian 32-bit integers)."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                    F.spark_partition_id().cast("long").alias("grp"))
    shared = df.sparkSession.sparkContext.broadcast(Shared(tokenizer_json))
    id_type = src.schema["id"].dataType.simpleString()
    schema = (f"id {id_type}, piece int, start long, length long, payload "
              f"{'array<int>' if payload == 'ids' else 'long'}, grp long, bin long, offset long, "
              "fill long")

    def slices(batch):
        # about a block of texts at once, one text at least
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
        at = 0
        while at < batch.num_rows:
            most = (size[at - 1] if at else 0) + BLOCK_CHARS
            to = min(at + BATCH_ROWS, max(at + 1, int(np.searchsorted(size, most, "right"))))
            yield batch.slice(at, to - at)
            at = to

    def pieces_of(enc, batch):
        texts = [x or "" for x in batch.column(1).to_pylist()]
        row, piece, start, length, load = [], [], [], [], []
        closing = np.array([closing_id], "<u4").tobytes()
        for r, ids in enumerate(enc.encode(texts)):
            ids += closing
            for p, (s, n) in enumerate(_cut(len(ids) // 4, capacity)):
                row.append(r)
                piece.append(p)
                start.append(s)
                length.append(n)
                part = ids[4 * s:4 * (s + n)]
                load.append(np.frombuffer(part, "<i4") if payload == "ids" else zlib.crc32(part))
        load_type = pa.list_(pa.int32()) if payload == "ids" else pa.int64()
        return pa.table({
            "id": batch.column(0).take(pa.array(row, pa.int64())),
            "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
            "length": pa.array(length, pa.int64()), "payload": pa.array(load, load_type)})

    def packed(held, grp, first):
        t = pa.concat_tables(held)
        home, offset, fill = best_fit(t["length"].to_numpy(), capacity)
        n = len(home)
        made = pa.array((np.int64(grp) << 40) + first + home)
        t = (t.append_column("grp", pa.array(np.full(n, grp, np.int64)))
             .append_column("bin", made).append_column("offset", pa.array(offset))
             .append_column("fill", pa.array(fill)))
        return t.to_batches(max_chunksize=1 << 14)

    def run(batches):
        enc, held, n, first, grp = shared.value.encoder(), [], 0, 0, None
        for b in (s for b in batches for s in slices(b)):
            grp = b.column(2)[0].as_py()
            held.append(pieces_of(enc, b))
            n += held[-1].num_rows
            if n >= LOCAL_PIECES:
                yield from packed(held, grp, first)
                held, n, first = [], 0, first + n
        if n:
            yield from packed(held, grp, first)
    return src.mapInArrow(run, schema)


def tree_rounds(bins: DataFrame, n_groups: int, capacity: int, fanin: int) -> DataFrame:
    """``bins``: bin, fill, grp of the underfull bins after the local round. Packs them up the tree;
    returns ``bin, seq, shift`` for those that moved into another bin ``seq``."""
    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("fill", "descending"), ("bin", "ascending")])
        home, offset, fill = best_fit(t["fill"].to_numpy(), capacity)
        return pa.table({"bin": t["bin"], "to": t["bin"].take(pa.array(home)),
                         "shift": pa.array(offset), "fill": pa.array(fill), "grp": t["grp"]})

    place = bins.select("bin", F.col("bin").alias("seq"), F.lit(0).cast("long").alias("shift"))
    level = 0
    while n_groups > 1:
        level, n_groups = level + 1, -(-n_groups // fanin)
        up = bins.withColumn("grp", F.floor(F.col("grp") / F.lit(fanin)).cast("long"))
        made = materialize(up.groupBy("grp").applyInArrow(
            pack, "bin long, to long, shift long, fill long, grp long"), f"packing-{level}")
        moved = made.filter(F.col("bin") != F.col("to")).select(
            F.col("bin").alias("from"), "to", F.col("shift").alias("by"))
        place = (place.join(moved, F.col("seq") == F.col("from"), "left")
                 .select("bin", F.coalesce("to", "seq").alias("seq"),
                         (F.col("shift") + F.coalesce("by", F.lit(0))).alias("shift")))
        bins = (made.filter((F.col("bin") == F.col("to"))
                            & (F.col("fill") < least_fill(level, capacity)))
                .select("bin", "fill", "grp"))
    return place.filter(F.col("bin") != F.col("seq"))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         tokenizer_json: str | None = None, capacity: int = CAPACITY, fanin: int = FANIN,
         payload: str = "ids", closing_id: int = CLOSING_ID) -> DataFrame:
    """One row per piece: ``id, piece, start, length, payload, sequence_id, offset``.

    ``tokenizer_json``: content of a ``tokenizers`` file with a byte-level pattern. The pieces of a
    ``sequence_id`` ordered by ``offset`` are a training sequence of at most ``capacity`` ids."""
    pieces = materialize(local_round(df, id_col, text_col, tokenizer_json or default_tokenizer(),
                                     capacity, payload, closing_id), "packing-pieces")
    heads = pieces.filter((F.col("offset") == 0) & (F.col("fill") < least_fill(0, capacity)))
    n_groups = (pieces.agg(F.max("grp")).first()[0] or 0) + 1
    moved = tree_rounds(heads.select("bin", "fill", "grp"), n_groups, capacity, fanin)
    return (pieces.join(moved.withColumnRenamed("bin", "from"), F.col("bin") == F.col("from"),
                        "left")
            .select("id", "piece", "start", "length", "payload",
                    F.coalesce("seq", "bin").alias("sequence_id"),
                    _moved(F.col("offset"), F.col("shift")).alias("offset")))


def _moved(offset: Column, shift: Column) -> Column:
    return offset + F.coalesce(shift, F.lit(0))


def default_tokenizer() -> str:
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def op12(spark, sf_dir: str) -> DataFrame:
    """``documents`` packed into sequences of 2048 tokens, pieces as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return (pack(docs, payload="crc").withColumnRenamed("id", "doc_id")
            .withColumnRenamed("payload", "ids_crc32"))


# tasks need no installed package: functions travel with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])
