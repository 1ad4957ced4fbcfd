"""SimHash fingerprints and the groups of near-equal ones.

Words are runs without white space after lower-casing A-Z; the fingerprint takes
the majority of each bit over the XXH64 values of the 3-word shingles.

Two fingerprints within 3 bits agree on at least 3 of 6 blocks, so each is listed
under its 20 choices of 3 blocks (31 to 33 bits) and meets the others there. A
bucket with more than `BUCKET` fingerprints is cut on: within it, two linked ones
also agree on 5 of 8 pieces of the remaining bits, which leaves at most 13 free
bits and so at most 8,192 different fingerprints a bucket, whatever the data. Only edges
that span a bucket's groups leave it, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thalweg.llm.components import components
from thalweg.staging import stage

SEED = 42
SHINGLE = 3
DISTANCE = 3
BUCKET = 4096
#: Bits of one step of the majority count; bounds the memory of a long text.
STEP = 255 * 256


def _widths(bits: int, parts: int) -> list[int]:
    return [bits // parts + (i < bits % parts) for i in range(parts)]


def _masks(positions: list[int], parts: int, agree: int) -> list[int]:
    """For each choice of `agree` of `parts` blocks of these bits, their mask."""
    blocks, at = [], 0
    for w in _widths(len(positions), parts):
        blocks.append(sum(1 << p for p in positions[at : at + w]))
        at += w
    return [sum(c) for c in combinations(blocks, agree)]


FIRST = _masks(list(range(64)), 2 * DISTANCE, DISTANCE)
SECOND = [_masks([p for p in range(64) if not m >> p & 1], DISTANCE + 5, 5) for m in FIRST]


def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint; zero for NULL and for texts without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - SHINGLE + 1)
    last = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts[:n].tolist(), last)), np.uint64, n
    )
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        part = h[at : at + STEP]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        if whole:  # sums of 255 bits fit a byte, which needs no widening copy
            set_bits += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        set_bits += bits[whole:].sum(axis=0, dtype=np.uint8)
    return int(sum(1 << i for i, c in enumerate(set_bits.tolist()) if 2 * c > n))


def text_hash() -> Column:
    """Tells texts of the same id apart; NULL counts as empty."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, h (a hash of the text) and fp (the fingerprint's 64 bits as a signed long), one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py()) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], ["doc_id", "h", "fp"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("h"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, "doc_id long, h long, fp long")


def edges(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that span the groups of fingerprints within 3 bits; `fps` (fp) holds distinct values."""
    once = stage(_met(_listed(fps, _first_keys), BUCKET), "simhash-edges")
    cut = _met(_listed(once.where("which >= 0"), _second_keys), None)
    return once.where("which < 0").select("a", "b").union(cut.select("a", "b"))


def groups(fps: DataFrame) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id reachable over links of fingerprints.

    `fps` has doc_id and fp. A NULL doc_id links like any other row but isn't a
    smallest one; a component without any doc_id has a NULL component_id.
    """
    rooted = _rooted(fps, F.col("doc_id"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def _rooted(fps: DataFrame, first: Column) -> DataFrame:
    """fp, the smallest `first` of its rows, and root: the smallest fingerprint reachable."""
    distinct = stage(fps.groupBy("fp").agg(F.min(first).alias("first")), "simhash-distinct")
    labels = components(edges(distinct.select("fp")))
    return distinct.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("label", "fp").alias("root"))


def simhash_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id for every row of `docs` (doc_id, text).

    NULL and empty texts, and those of white space, have fingerprint zero and link
    to each other and to any fingerprint of at most 3 set bits. Repeated rows stay.
    An empty table gives an empty result. Other columns aren't read.
    """
    return groups(stage(fingerprints(docs), "simhash-fps"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """Of every group one row of `docs`, with all its columns: that of the smallest doc_id, NULL last, then of the smallest hash of its text."""
    fps = stage(fingerprints(docs), "simhash-fps")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    kept = _rooted(fps, order).groupBy("root").agg(F.min("first").alias("f")).select("f.doc_id", "f.h")
    kept = kept.select(F.xxhash64("doc_id", "h").alias("__key"), F.col("h").alias("__h"))
    # rows meet by id and text, so a hot group stays spread; only repeated rows share both
    keyed = docs.withColumns({"__key": F.xxhash64(F.col("doc_id").cast("long"), text_hash()), "__h": text_hash()})
    return keyed.join(kept, ["__key", "__h"], "left_semi").dropDuplicates(["__key", "__h"]).select(*docs.columns)


def _listed(df: DataFrame, keys) -> DataFrame:
    return df.mapInArrow(keys, "which long, key long, key2 long, fp long")


def _first_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for which, mask in enumerate(FIRST):
            yield _rows(which, v & np.uint64(mask), np.zeros(len(v), np.uint64), v)


def _second_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        chosen = b.column(0).to_numpy(zero_copy_only=False)
        values = b.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
        for which in np.unique(chosen).tolist():
            v = values[chosen == which]
            for sub, mask in enumerate(SECOND[which]):
                yield _rows(which * 64 + sub, v & np.uint64(FIRST[which]), v & np.uint64(mask), v)


def _rows(which: int, key, key2, fp) -> pa.RecordBatch:
    cols = [np.full(len(fp), which, np.int64), key.view(np.int64), key2.view(np.int64), fp.view(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["which", "key", "key2", "fp"])


def _met(listed: DataFrame, largest: int | None) -> DataFrame:
    """which, a, b: the edges of each bucket (which = -1), and the members (b) of those over `largest`."""
    by = ["which", "key", "key2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, large = np.empty((4, 0), np.int64), None
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if large is not None:  # the bucket before it goes on
                n = int((rows[:3] == large[:, None]).all(axis=0).sum())
                yield _out(int(large[0]), rows[3, :n], rows[3, :n])
                if n == rows.shape[1]:
                    continue
                rows, large = rows[:, n:], None
            rows = np.concatenate([rest, rows], axis=1)
            cuts = _starts(rows)
            last = int(cuts[-1]) if len(cuts) else 0
            yield from _edges(rows[:, :last], largest)
            rest = rows[:, last:]
            if largest is not None and rest.shape[1] > largest:
                large = rest[:3, 0].copy()
                yield _out(int(large[0]), rest[3], rest[3])
                rest = rest[:, :0]
        yield from _edges(rest, largest)

    return listed.repartition(*by).sortWithinPartitions(*by, "fp").mapInArrow(run, "which long, a long, b long")


def _starts(rows: np.ndarray) -> np.ndarray:
    if rows.shape[1] == 0:
        return np.empty(0, np.int64)
    new = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    return np.concatenate([[0], np.flatnonzero(new) + 1])


def _edges(rows: np.ndarray, largest: int | None) -> Iterator[pa.RecordBatch]:
    """For whole buckets."""
    starts = _starts(rows)
    sizes = np.diff(np.append(starts, rows.shape[1]))
    v = rows[3].view(np.uint64)
    found = []
    small = np.repeat(sizes, sizes) <= 8
    for d in range(1, 8):  # all pairs of small buckets, at each distance in the order
        i = np.flatnonzero(small[:-d] & (rows[:3, :-d] == rows[:3, d:]).all(axis=0))
        near = i[np.bitwise_count(v[i] ^ v[i + d]) <= DISTANCE]
        found.append((v[near], v[near + d]))
    for at in np.flatnonzero(sizes > 8).tolist():
        s, n = int(starts[at]), int(sizes[at])
        if largest is not None and n > largest:
            yield _out(int(rows[0, s]), rows[3, s : s + n], rows[3, s : s + n])
        else:
            found.append(_spanned(v[s : s + n]))
    yield _out(-1, *(np.concatenate(x) for x in zip(*found)))


def _spanned(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from the first member found of each group of linked values to the others."""
    heads, members, left = [], [], v
    while len(left):
        head, todo, left = left[0], [left[0]], left[1:]
        while todo and len(left):
            near = np.bitwise_count(left ^ todo.pop()) <= DISTANCE
            if near.any():
                todo += list(left[near])
                heads.append(np.full(int(near.sum()), head))
                members.append(left[near])
                left = left[~near]
    if not heads:
        return v[:0], v[:0]
    return np.concatenate(heads), np.concatenate(members)


def _out(which: int, a, b) -> pa.RecordBatch:
    cols = [np.full(len(a), which, np.int64), a.view(np.int64), b.view(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["which", "a", "b"])
