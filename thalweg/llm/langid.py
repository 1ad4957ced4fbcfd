"""Language identification with bit-sliced Bloom filters of letter trigrams.

Every letter gives one trigram: itself and its neighbours, where what isn't a
letter reads as a gap. Training counts trigrams per language in Spark and puts a
trigram into a language's filter if it is common enough there, and not much
rarer than where it is most common. The filters share one table: slot i holds a
bit per language, so one lookup at `HASHES` slots, ANDed, gives the bitmask of
all languages that hold the trigram, in words of `BITS` languages. A text's language is the one with most set
bits after taking off the false positives that its filter's fill lets expect.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from thalweg.staging import stage

SLOTS = 1 << 20
HASHES = 3
#: Least share of a language's trigrams; so a filter holds at most 100,000.
LEAST_SHARE = 1e-5
#: Least share against the language where the trigram is most common.
LEAST_RATIO = 0.5
UNKNOWN = "und"
#: Languages in one word of a mask. A model takes 8 bytes a slot for each begun word, 8 MB at `SLOTS`.
BITS = 64
#: Characters that are looked at together; longer texts are read in slices of so many, cut between words.
STEP = 1 << 20


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    slots: np.ndarray  # (words, slots), of the smallest unsigned type with a bit for each language of a word

    @property
    def false_rates(self) -> np.ndarray:
        fill = [float(_bit(self.slots[i // BITS], i).mean()) for i in range(len(self.languages))]
        return np.array(fill) ** HASHES


def _bit(words: np.ndarray, language: int) -> np.ndarray:
    return (words >> words.dtype.type(language % BITS)) & words.dtype.type(1)


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _slices(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Positions in `texts` and lower-cased slices, about `STEP` characters at a time; cut between words."""
    at, parts, size = [], [], 0
    for i, t in enumerate(texts):
        start = 0
        while start < len(t or ""):
            stop = start + STEP
            while stop < len(t) and t[stop].isalpha():
                stop += 1
            part, start = t[start:stop].lower(), stop
            at.append(i)
            parts.append(part)
            size += len(part)
            if size >= STEP:
                yield at, parts
                at, parts, size = [], [], 0
    if parts:
        yield at, parts


def _letters(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All characters (a gap before each part and at the end), the letters' positions, and how many letters each part has."""
    codes = np.frombuffer(("\n" + "\n".join(parts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[codes]
    ends = np.cumsum([len(p) + 1 for p in parts])
    index = np.flatnonzero(letter)
    return np.where(letter, codes, 0), index, np.diff(np.searchsorted(index, ends), prepend=0)


def _trigrams(codes: np.ndarray, index: np.ndarray) -> np.ndarray:
    c = codes.astype(np.uint64)
    pairs = (c[:-1] << np.uint64(21)) | c[1:]
    return (pairs[index - 1] << np.uint64(21)) | c[index + 1]


def _count(codes: np.ndarray, index: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, trigrams, counts); `group` has each letter's."""
    alphabet, dense = np.unique(codes, return_inverse=True) if codes.max() > 0xFFFF else _ranked(codes)
    n = len(alphabet)
    for g in np.unique(group).tolist():
        i = index[group == g]
        if n**3 <= 1 << 24:
            packed = (dense[i - 1] * n + dense[i]) * n + dense[i + 1]
            counts = np.bincount(packed)
            found = np.flatnonzero(counts)
            a, b, c = (alphabet[x].astype(np.uint64) for x in (found // (n * n), found // n % n, found % n))
            yield g, (a << np.uint64(42)) | (b << np.uint64(21)) | c, counts[found]
        else:
            yield g, *np.unique(_trigrams(codes, i), return_counts=True)


def _ranked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    seen = np.zeros(0x10000, bool)
    seen[codes] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[codes]


def trigram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all rows of `docs` (lang, text) with a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            kinds = {x: k for k, x in enumerate(dict.fromkeys(names))}
            found: dict[int, list] = {}
            for at, parts in _slices(texts):
                codes, index, sizes = _letters(parts)
                group = np.repeat(np.array([kinds[names[i]] for i in at]), sizes)
                for g, grams, n in _count(codes, index, group):
                    found.setdefault(g, []).append((grams, n))
            for x, k in kinds.items():
                if k in found:
                    grams, inverse = np.unique(np.concatenate([f[0] for f in found[k]]), return_inverse=True)
                    n = np.bincount(inverse, np.concatenate([f[1] for f in found[k]])).astype(np.int64)
                    cols = [pa.array([x] * len(grams)), pa.array(grams.view(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(cols, ["lang", "gram", "n"])

    known = docs.where(F.col("lang").isNotNull()).select("lang", "text")
    each = known.mapInArrow(run, "lang string, gram long, n long")
    return each.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> Model:
    """Learn from `docs` (lang, text); rows without a language or without letters teach nothing.

    What reaches the driver is one row per language and at most `SLOTS` slots for each word of `BITS` languages.
    """
    counts = stage(trigram_counts(docs), "langid-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang").collect()
    languages = tuple(r.lang for r in totals)
    if not languages:
        return Model((), np.zeros((0, SLOTS), np.uint8))
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if np.iinfo(k).bits >= min(len(languages), BITS))
    spark = docs.sparkSession
    bit = (np.uint64(1) << np.arange(len(totals), dtype=np.uint64) % np.uint64(BITS)).view(np.int64).tolist()
    rows = [(r.lang, float(r.total), i // BITS, bit[i]) for i, r in enumerate(totals)]
    known = F.broadcast(spark.createDataFrame(rows, "lang string, total double, word int, bit long"))
    shares = counts.join(known, "lang").select("gram", "word", "bit", (F.col("n") / F.col("total")).alias("share"))
    most = shares.groupBy("gram").agg(F.max("share").alias("most"))
    held = shares.join(most, "gram").where((F.col("share") >= LEAST_SHARE) & (F.col("share") >= LEAST_RATIO * F.col("most")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grams = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for slots in _places(grams):
                yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), b.column(1), b.column(2)], ["slot", "word", "bits"])

    filled = held.select("gram", "word", "bit").mapInArrow(place, "slot long, word int, bits long")
    filled = filled.groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
    slots = np.zeros((rows[-1][2] + 1, SLOTS), kind)
    slots[filled["word"].to_numpy(), filled["slot"].to_numpy()] = filled["bits"].to_numpy().view(np.uint64).astype(kind)
    return Model(languages, slots)


def _places(grams: np.ndarray) -> Iterator[np.ndarray]:
    """The slots of each trigram, by double hashing."""
    h = grams * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    step = (h >> np.uint64(40)) | np.uint64(1)
    h >>= np.uint64(8)
    for _ in range(HASHES):
        yield h & np.uint64(SLOTS - 1)
        h = h + step


def predict_texts(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The languages and scores of these texts."""
    hits = np.zeros((len(texts), len(model.languages)))
    letters = np.zeros(len(texts))
    for at, parts in _slices(texts):
        codes, index, sizes = _letters(parts)
        np.add.at(letters, at, sizes)
        if not len(index) or not model.languages:
            continue
        grams = _trigrams(codes, index)
        places = list(_places(grams))
        some = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[some]
        for word, table in enumerate(model.slots):
            mask = np.bitwise_and.reduce([table[slots] for slots in places])
            for i in range(word * BITS, min((word + 1) * BITS, len(model.languages))):
                np.add.at(hits[:, i], np.array(at)[some], np.add.reduceat(_bit(mask, i).astype(np.int32), starts))
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    false = model.false_rates
    share = (hits / np.maximum(letters, 1)[:, None] - false) / np.maximum(1 - false, 1e-9)
    best = share.argmax(axis=1)
    score = np.where(letters > 0, np.clip(share.max(axis=1), 0, 1), 0.0)
    return [model.languages[k] if n else UNKNOWN for k, n in zip(best.tolist(), letters.tolist())], score


def predict(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """`docs` with lang_pred and score added, under `names`, which must not be names of its columns.

    lang_pred is the language whose filter holds the largest corrected share of
    the text's trigrams, ties going to the first name; that share is the score.
    NULL texts and texts without a letter are `und` with score 0, and so is
    everything if no language was learned. Repeated rows and NULLs elsewhere stay.
    """
    columns = docs.columns
    schema = StructType([*docs.schema, StructField(names[0], StringType()), StructField(names[1], DoubleType())])
    at = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, score = predict_texts(model, b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.string()), pa.array(score)], [*columns, *names])

    return docs.mapInArrow(run, schema)


def held_out(id_col: str, parts: int, part: int) -> Column:
    """crc32 of the id's text modulo `parts` is `part`; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == part


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the rows that aren't held out.

    One row per row, repeated ones included. NULL, empty and letterless texts are `und` with
    score 0 and teach nothing, as do rows without lang; ties go to the first language by name.
    A NULL id counts as empty text in the division. An empty table gives none; other columns aren't read.
    """
    out = held_out("doc_id", 3, 1)
    known = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), out.alias("held_out"))
    model = fit(known.where(~F.col("held_out")))
    return predict(known.select("doc_id", "held_out", "text"), model).drop("text")
