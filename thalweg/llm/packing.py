"""Packing documents into token sequences along a space-filling curve.

Every document is tokenized once; its tokens' hashed directions average to a point in
a few dimensions, whose place on a Hilbert curve orders the documents. The curve is
cut into cells, cells with many tokens are dealt out further by a hash (so copies
of one document, which share a place, don't meet in one task), and each part is
sorted. Parts know from the cells' token counts where they begin in the whole
stream, so sequences run on across parts and only the very last one is padded.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from thalweg.staging import stage

if TYPE_CHECKING:
    from tokenizers import Tokenizer

LENGTH = 2048
END_ID = 1
#: Dimensions and bits of each on the curve, and the spread of means that its cells resolve best.
DIMENSIONS, BITS, SPREAD = 4, 8, 0.15
#: Leading bits of the place that name a cell, the tokens a part should hold at least, and about the most parts.
CELL_BITS, PART_TOKENS, PARTS = 14, 1_000_000, 20_000
STEP = 1 << 20
#: Chunks of text remembered by a worker (twice so many at most), and the longest one.
REMEMBERED, LONGEST = 600_000, 48
#: Characters of text whose chunks are learned together.
TOGETHER = 1 << 21
#: Characters that, at a chunk's end, are tokens apart from a letter or digit before them.
_ENDS = ".,;:!?*$%&#|"
#: Bytes of UTF-8 by kind; chunks end at white space, and between an ASCII letter or digit and one of `_ENDS`.
_ALNUM, _END, _SPACE = 1, 4, 16
_SPACES = b"\t\n\v\f\r "
_KINDS = bytes(_SPACE if i in _SPACES else _END if i in _ENDS.encode() else _ALNUM if i < 128 and chr(i).isalnum() else 0 for i in range(256))
_GAP = re.compile("[\t\n\v\f\r ]")


def _ends_apart(core: str) -> bool:
    """Whether punctuation after `core` is a token of its own: what the tokenizer makes of its end is a letter or digit.

    The tokenizer composes characters and lower-cases them first. Some letters end in a combining
    mark then, which it joins with what follows.
    """
    return core[-1].isascii() and core[-1].isalnum() or unicodedata.normalize("NFC", core[-2:]).lower()[-1].isalnum()


def _one_word(chunk: str) -> bool:
    """Whether the chunk is letters only, to the tokenizer as well, and so one word of it."""
    return chunk.isalpha() and (chunk.isascii() or unicodedata.is_normalized("NFC", chunk) and chunk.lower().isalpha())


class Encoder:
    """Token ids (unsigned, 16 or 32 bits) of texts, by a `tokenizers` file.

    White space always parts tokens, so a text's ids are those of its chunks, and
    the ids of recent chunks are remembered. Arrow numbers the chunks of many texts; Python
    sees each different one once, and their ids are dealt out by number. Chunks of letters
    alone are learned without offsets, by the tokens that end a word.
    """

    def __init__(self, path: str, remembered: int | None = None) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.remembered = REMEMBERED if remembered is None else remembered

        self.tokenizer = Tokenizer.from_file(path)
        # lower-case ASCII words are normalised already, and parted by white space alone
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = WhitespaceSplit()
        self.kind = np.uint16 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None  # which ids end a word, where the vocabulary marks that
        if suffix:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
            self.ends[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith(suffix)]] = True
        # tokens that are told before anything is lower-cased or parted
        self.added = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn_words(self, tokenizer: Tokenizer, words: list[str]) -> None:
        """Learn words of letters alone, if `tokenizer` makes as many words of them."""
        if self.ends is None or not words:
            return
        joined = [" ".join(words[s : s + 512]) for s in range(0, len(words), 512)]
        coded = tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.array(c.ids, self.kind) for c in coded])
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(words):
            data, size = ids.tobytes(), ids.itemsize
            cuts = [0, *(cuts * size).tolist()]
            self.new.update((c, data[a:b]) for c, a, b in zip(words, cuts, cuts[1:]))

    def _learn(self, chunks: list[str]) -> None:
        plain = [c for c in chunks if c.isascii() and c.isalpha() and c.islower()]
        self._learn_words(self.plain, plain)
        self._learn_words(self.tokenizer, [c for c in chunks if c not in self.new and _one_word(c)])
        chunks = [c for c in chunks if c not in self.new]
        for s in range(0, len(chunks), 2048):
            some = chunks[s : s + 2048]
            coded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ends = np.cumsum([len(c) + 1 for c in some])
            at = np.searchsorted(ends, np.array([o[0] for o in coded.offsets], np.int64), "right")
            ids = np.array(coded.ids, self.kind)
            cuts = np.searchsorted(at, np.arange(len(some) + 1)).tolist()
            for c, a, b in zip(some, cuts, cuts[1:]):
                self.new[c] = ids[a:b].tobytes()

    def _add(self, unknown: set[str]) -> list[str]:
        """Learn these chunks; returns those too long to be remembered."""
        self.new.update((c, self.old[c]) for c in unknown if c in self.old)
        unknown = unknown.difference(self.new)
        if not unknown:
            return []
        long = {c: self._whole(c) for c in unknown if len(c) > LONGEST}
        ended = {c: core for c in unknown if c[-1] in _ENDS and c not in long and (core := c.rstrip(_ENDS)) and _ends_apart(core)}
        wanted = {*unknown.difference(long, ended), *ended.values(), *(c[len(core) :] for c, core in ended.items())}
        wanted = {c for c in wanted if c not in self.new}
        self.new.update((c, self.old[c]) for c in wanted if c in self.old)
        self._learn([c for c in wanted if c not in self.new])
        self.new.update((c, self.new[core] + self.new[c[len(core) :]]) for c, core in ended.items())
        self.new.update(long)
        return list(long)

    def encode(self, text: str) -> bytes:
        return b"".join(self._sliced(text))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; texts are taken together, up to `TOGETHER` characters, to learn their chunks at once."""
        out: list[bytes] = []
        some: list[str] = []
        size = 0
        for text in texts:
            if size + len(text) > TOGETHER or len(text) > STEP:
                out += self._together(some)
                some, size = [], 0
            if len(text) > STEP:
                out.append(self.encode(text))
            else:
                some.append(text)
                size += len(text)
        return out + self._together(some)

    def _chunks(self, texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The chunks of all texts, one after the other, and the number of those before the end of each text."""
        small = [t.lower() for t in texts]
        asis = [any(a in t for a in self.added) for t in small]
        raw = b"\n".join([*texts, b""])
        lower = b"\n".join([*(t if o else s for t, s, o in zip(texts, small, asis)), b""])
        lengths = [len(t) + 1 for t in texts]
        kinds = np.frombuffer(raw.translate(_KINDS), np.uint8)
        kept = kinds != _SPACE
        first = kept.copy()
        first[1:] &= ~kept[:-1]
        ended = kinds[:-1] + kinds[1:] == _ALNUM + _END
        if any(asis):
            ended &= ~np.repeat(asis, lengths)[1:]
        first[1:] |= ended
        if not raw.isascii():  # a mark that follows may join a letter before that is lower-cased
            was, now = np.frombuffer(raw, np.uint8), np.frombuffer(lower, np.uint8).copy()
            joins = np.flatnonzero((was[1:] >= 0x80) & (was[:-1] != now[:-1]))
            now[joins] = was[joins]
            lower = now.tobytes()
        offsets = np.append(np.flatnonzero(first[kept]), np.count_nonzero(kept))
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(lower.translate(None, _SPACES))]
        chunks = pa.Array.from_buffers(pa.large_utf8(), len(offsets) - 1, buffers).dictionary_encode()
        return chunks, np.searchsorted(np.flatnonzero(first), np.cumsum(lengths))

    def _together(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        chunks, upto = self._chunks([t.encode() for t in texts])
        names = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        long = self._add(set(names).difference(self.new))
        known = pa.array([self.new[c] for c in names], pa.large_binary())
        dealt = known.take(chunks.indices)
        ids = dealt.buffers()[2]
        cuts = np.frombuffer(dealt.buffers()[1], np.int64)[np.append(0, upto)].tolist()
        for c in long:
            del self.new[c]
        if len(self.new) > self.remembered:
            self.old, self.new = self.new, {}
        return [ids[a:b].to_pybytes() if a < b else b"" for a, b in zip(cuts, cuts[1:])]

    def _sliced(self, text: str) -> Iterator[bytes]:
        at = 0
        while at < len(text):
            gap = _GAP.search(text, at + STEP)
            to = gap.start() if gap else len(text)
            yield self._together([text[at:to]])[0]
            at = to


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int | None = None) -> Encoder:
    return Encoder(path, remembered)


@lru_cache(maxsize=2)
def _directions(n: int) -> np.ndarray:
    return np.random.default_rng(4).standard_normal((n, DIMENSIONS)).astype(np.float32)


def points(ids: np.ndarray, starts: np.ndarray, vocabulary: int) -> np.ndarray:
    """Cell coordinates of documents (their ids one after the other): mean directions on a fixed grid."""
    total = np.add.reduceat(_directions(vocabulary)[ids], starts, axis=0)
    mean = total / np.diff(np.append(starts, len(ids)))[:, None]
    share = 1 / (1 + np.exp(-np.clip(mean / SPREAD * 1.7, -50, 50)))
    return np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert(cells: np.ndarray) -> np.ndarray:
    """Places of cells (rows of coordinates) along the Hilbert curve of `BITS` bits a dimension."""
    x = [cells[:, i].copy() for i in range(cells.shape[1])]
    n = len(x)
    bit = 1 << (BITS - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            on = (x[i] & bit) > 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (BITS - 1)
    while bit > 1:
        turn = np.where(x[n - 1] & bit, turn ^ (bit - 1), turn)
        bit >>= 1
    place = np.zeros_like(x[0])
    for b in range(BITS - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | (((x[i] ^ turn) >> b) & 1)
    return place


def tokenized(docs: DataFrame, path: str, remembered: int | None = None) -> DataFrame:
    """doc_id, place (on the curve), salt (a hash that tells rows of one place apart), n and ids of every row of `docs`.

    `ids` are little-endian integers of the width that the vocabulary needs, ending with `END_ID`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, remembered)
        end, size = np.array([END_ID], own.kind).tobytes(), np.dtype(own.kind).itemsize
        vocabulary = max(own.tokenizer.get_vocab_size(with_added_tokens=True), END_ID + 1)
        for b in batches:
            at = 0
            while at < b.num_rows:
                texts, total, first = [], 0, at
                while at < b.num_rows and total < TOGETHER:
                    texts.append(b.column(1)[at].as_py() or "")
                    total += len(texts[-1])
                    at += 1
                coded = [c + end for c in own.encode_all(texts)]
                n = np.array([len(c) // size for c in coded], np.int64)
                place = hilbert(points(np.frombuffer(b"".join(coded), own.kind), np.cumsum(n) - n, vocabulary))
                salt = np.array([zlib.crc32(c, (d or 0) & 0xFFFFFFFF) for c, d in zip(coded, b.column(0).slice(first, at - first).to_pylist())], np.int64)
                cols = [b.column(0).slice(first, at - first), pa.array(place), pa.array(salt), pa.array(n), pa.array(coded, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "place", "salt", "n", "ids"])
            pa.default_memory_pool().release_unused()  # workers stay; what Arrow keeps would count with the next stage's

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, "doc_id long, place long, salt long, n long, ids binary")


PIECES = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def pack(docs: DataFrame, path: str, remembered: int | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents follow one another in curve order and are cut where a sequence is
    full, so all sequences but the last hold `LENGTH` tokens. NULL and empty texts are a
    single end id. Repeated rows are packed each, NULL ids stay; an empty table gives
    no piece. Other columns aren't read.

    `remembered` bounds the chunks that a worker remembers (twice so many at most): it
    trades memory for time and changes no result.
    """
    rows = stage(tokenized(docs, path, remembered), "packing-tokens")
    cell = F.shiftright("place", DIMENSIONS * BITS - CELL_BITS)
    spark = docs.sparkSession
    # both cells and parts are bounded, by CELL_BITS and PARTS
    cells = sorted((r.cell, r.n) for r in rows.groupBy(cell.alias("cell")).agg(F.sum("n").alias("n")).collect())
    full = max(PART_TOKENS, sum(n for _, n in cells) // PARTS)
    first, table, filled = 0, [], 0
    for c, n in cells:
        splits = -(-n // full)
        if splits > 1 and filled:
            first, filled = first + 1, 0
        table.append((c, first, splits))
        filled += n
        if splits > 1 or filled >= full:
            first, filled = first + splits, 0
    dealt = spark.createDataFrame(table, "cell long, first int, splits int")
    parts = rows.withColumn("cell", cell).join(F.broadcast(dealt), "cell")
    parts = parts.select((F.col("first") + F.pmod("salt", F.col("splits"))).cast("int").alias("part"), "place", "salt", "doc_id", "n", "ids")
    base, total = {}, 0
    for r in sorted(parts.groupBy("part").agg(F.sum("n").alias("n")).collect()):
        base[r.part], total = total, total + r.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = encoder(path, remembered).kind
        now, at = None, 0
        for b in batches:
            pieces: list[tuple] = []
            for part, doc_id, ids in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), b.column(5)):
                if part != now:
                    now, at = part, base[part]
                tokens = np.frombuffer(ids.as_buffer(), kind)
                start = 0
                while start < len(tokens):
                    length = min(len(tokens) - start, LENGTH - at % LENGTH)
                    crc = zlib.crc32(tokens[start : start + length].astype("<u4"))
                    pieces.append((doc_id, start, length, crc, len(tokens), at // LENGTH, at % LENGTH))
                    start, at = start + length, at + length
            if pieces:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pieces)], schema=PIECES)

    if not base:
        return spark.createDataFrame([], from_arrow_schema(PIECES))
    order = ["part", "place", "salt", "doc_id", "n"]
    return parts.repartition(len(base), "part").sortWithinPartitions(*order).mapInArrow(run, from_arrow_schema(PIECES))
