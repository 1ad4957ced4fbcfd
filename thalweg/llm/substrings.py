"""Exact removal of repeated byte strings, by induced sorting of anchored suffixes.

All suffixes are too many to shuffle, so sorting follows the way of induced sorting:
sort a sample that is chosen by content, and induce the rest from it. The sample are
anchors, the 32-byte strings with the smallest hash among any 69 in a row. Every
100-byte string holds an anchor, and equal strings hold it at the same place, so
strings can only be equal where anchors are.

First, each task settles what repeats within it. Then Spark's external sort (which
spills to disk) brings equal anchors together, and drops those that occur once. Where an anchor's whole surroundings repeat, all of it is
a repeat. Second, where they differ, the suffixes at the anchors are sorted, with the
common prefix of neighbours; going left from there byte by byte, tuples of the byte
and the name of what follows give the next names. A string is told by its left name and
the common prefixes at its right end, and its first place by (document, start) stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from thalweg.staging import stage

LENGTH, ANCHOR = 100, 32
#: Bytes on either side of an anchor that a string with it can reach.
SIDE = LENGTH - ANCHOR
#: Bits of the filter for documents that take part in a join; its size doesn't grow, only its sharpness falls.
FILTER_BITS = 1 << 23
#: Rows that are named at a time, at least one anchor's; anchors with more than LARGE different surroundings go string by string.
ROWS, LARGE = 1 << 14, 1 << 17
STEP = 1 << 20
#: Anchors that a task looks at together.
TASK_ROWS = 1 << 17

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors in these bytes, and their hashes; none below `LENGTH` bytes."""
    found = [_anchors(data[s : s + STEP + LENGTH - 1]) for s in range(0, max(0, len(data) - LENGTH + 1), STEP)]
    at = [np.zeros(0, np.int64)] + [p + i * STEP for i, (p, _) in enumerate(found)]
    position, first = np.unique(np.concatenate(at), return_index=True)
    return position, np.concatenate([np.zeros(0, np.uint64)] + [h for _, h in found])[first]


def _anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    powers = np.full(n, _BASE, np.uint64)
    powers[0] = 1
    back = np.full(n, _INVERSE, np.uint64)
    back[0] = 1
    powers, back = np.cumprod(powers), np.cumprod(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * back)])
    m = n - ANCHOR + 1
    h = (sums[ANCHOR:] - sums[:m]) * powers[:m]  # the polynomial of each ANCHOR bytes
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    width = LENGTH - ANCHOR + 1
    least, w = h, 1
    while 2 * w <= width:
        least = np.minimum(least[: len(least) - w], least[w:])
        w *= 2
    least = np.minimum(least[: m - width + 1], least[width - w : m - w + 1])  # of each width in a row
    # an anchor is the least of some window that holds it: the greatest of the windows' least values there
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    most, w = padded, 1
    while 2 * w <= width:
        most = np.maximum(most[: len(most) - w], most[w:])
        w *= 2
    most = np.maximum(most[:m], most[width - w : m + width - w])
    position = np.flatnonzero(h == most)
    return position, h[position]


def _key() -> tuple[Column, Column]:
    """A document's id (NULL last) and a mark that tells texts of the same id apart."""
    return F.col("doc_id"), F.hash(F.coalesce("text", F.lit("")))


def _documents(docs: DataFrame) -> DataFrame:
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.select(F.col("doc_id").isNull().cast("int").alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), _key()[1].alias("h"), "text")


def occurrences(documents: DataFrame) -> DataFrame:
    """Anchors: akey, chash (of all bytes a string with it can reach), the document, pos, and the bytes after it (at most SIDE).

    Of equal surroundings in one task only the first place is listed as such. The others
    are repeats for sure: they get an `after` below 0 and a key of their own, so that very
    frequent ones don't gather anywhere.
    """
    names = ["akey", "chash", "none", "id", "h", "pos", "after"]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32())

    def settled(kept: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(kept, axis=1)
        rows = rows[:, np.lexsort(rows[5::-1])]
        new = np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)])
        first = np.maximum.accumulate(np.where(new, np.arange(rows.shape[1]), 0))
        again = ~new & (rows[2:6] != rows[2:6, first]).any(axis=0)
        rows[0, again] = (rows[3, again] * 0x1E3779B97F4A7C15 + rows[5, again]) * 0x2545F4914F6CDD1D
        rows[6, again] = -1 - rows[6, again]
        rows = rows[:, new | again]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(rows, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, kept, size = xxhash.xxh3_64_intdigest, [], 0
        for b in batches:
            for i in range(b.num_rows):
                text = b.column(3)[i].as_buffer()
                if text is None or text.size < LENGTH:
                    continue
                data = np.frombuffer(text, np.uint8)
                pos, akey = anchors(data)
                low, high = np.maximum(pos - SIDE, 0), np.minimum(pos + ANCHOR + SIDE, len(data))
                raw = memoryview(text)
                # where the surroundings end early is part of them
                chash = np.fromiter(
                    (digest(raw[s:e], (e - s) * 256 + p - s) for s, e, p in zip(low.tolist(), high.tolist(), pos.tolist())), np.uint64, len(pos)
                )
                fixed = [np.full(len(pos), b.column(c)[i].as_py(), np.int64) for c in range(3)]
                kept.append(np.stack([akey.view(np.int64), chash.view(np.int64), *fixed, pos, high - pos - ANCHOR]))
                size += len(pos)
                if size >= TASK_ROWS:
                    yield settled(kept)
                    kept, size = [], 0
        if kept:
            yield settled(kept)

    return documents.mapInArrow(run, "akey long, chash long, none int, id long, h int, pos int, after int")


def _joined(run, rows: int = 1 << 15):
    """`run` with its small batches put together."""

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for b in run(batches):
            kept.append(b)
            size += b.num_rows
            if size >= rows:
                yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
                kept, size = [], 0
        if kept:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()

    return together


_DOCUMENT = [("none", pa.int32()), ("id", pa.int64()), ("h", pa.int32())]
_FOUND = pa.schema([*_DOCUMENT, ("start", pa.int32()), ("stop", pa.int32()), ("akey", pa.int64())])


def _found(rows: np.ndarray, start: np.ndarray, stop: np.ndarray, akey: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of none, id, h; with an akey they ask for an anchor's surroundings, else they are repeats."""
    cols = [pa.array(rows[0].astype(np.int32)), pa.array(rows[1]), pa.array(rows[2].astype(np.int32)), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))]
    last = pa.array(akey) if akey is not None else pa.nulls(len(start), pa.int64())
    return pa.RecordBatch.from_arrays([*cols, last], schema=_FOUND)


def compared(occurring: DataFrame) -> DataFrame:
    """Repeats where the whole surroundings of an anchor repeat, and the first places (with akey) of those that differ for one anchor."""
    order = ["akey", "chash", "none", "id", "h", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, asked = None, False  # the first place of the surroundings that may go on, and if their anchor has others
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            done = rows[:, rows[6] < 0]
            yield _found(done[2:5], np.maximum(done[5] - SIDE, 0), done[5] + ANCHOR - 1 - done[6])
            rows = rows[:, rows[6] >= 0]
            if rows.shape[1] == 0:
                continue
            old = carry is not None
            if old:
                rows = np.concatenate([carry[:, None], rows], axis=1)
            n = rows.shape[1]
            new_anchor = np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])
            new = new_anchor | np.concatenate([[True], rows[1, 1:] != rows[1, :-1]])
            anchor = np.cumsum(new_anchor) - 1
            several = np.bincount(anchor, new) > 1
            known = old and asked
            several[0] |= known
            ask = new & several[anchor]
            ask[0] &= not known
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            repeat = ~new & (rows[2:6] != rows[2:6, first]).any(axis=0)
            pos, after = rows[5], rows[6]
            yield _found(rows[2:5, repeat], np.maximum(pos[repeat] - SIDE, 0), pos[repeat] + ANCHOR + after[repeat])
            yield _found(rows[2:5, ask], pos[ask], pos[ask], rows[0, ask])
            carry, asked = rows[:, first[-1]].copy(), bool(several[-1])

    return occurring.repartition("akey").sortWithinPartitions(*order).mapInArrow(_joined(run), from_arrow_schema(_FOUND))


def _among(documents: DataFrame, keys: DataFrame, inside: bool = True) -> DataFrame:
    """The documents that may be among `keys` (none, id, h), or surely aren't, by a filter of fixed size."""
    mark = F.pmod(F.xxhash64("none", "id", "h"), F.lit(FILTER_BITS))
    bits = keys.select(mark.alias("bit")).groupBy(F.shiftright("bit", 5).cast("int").alias("word"))
    filled = bits.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 AS int))")).alias("bits")).toArrow()
    words = np.zeros(FILTER_BITS // 32, np.uint32)
    words[filled["word"].to_numpy()] = filled["bits"].to_numpy().astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bit = b.column(4).to_numpy(zero_copy_only=False)
            held = (words[bit >> 5] >> (bit & 31).astype(np.uint32)) & np.uint32(1) > 0
            yield b.filter(pa.array(held == inside))

    return documents.withColumn("bit", mark).mapInArrow(run, "none int, id long, h int, text string, bit long").drop("bit")


def surroundings(documents: DataFrame, asked: DataFrame) -> DataFrame:
    """The bytes around the anchors asked for: left (SIDE) and right (from the anchor on), padded, with their true lengths."""
    each = asked.groupBy("none", "id", "h").agg(F.collect_list(F.struct("start", "akey")).alias("asked"))
    near = _among(documents, asked).join(each, ["none", "id", "h"]).select("none", "id", "h", "text", "asked").dropDuplicates(["none", "id", "h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                text, fixed = bytes(b.column(3)[i].as_buffer()), [b.column(c)[i].as_py() for c in range(3)]
                out = []
                for a in b.column(4)[i].as_py():
                    pos = a["start"]
                    left, right = text[max(0, pos - SIDE) : pos], text[pos : pos + ANCHOR + SIDE]
                    out.append((a["akey"], *fixed, pos, len(left), len(right), left.rjust(SIDE, b"\0"), right.ljust(ANCHOR + SIDE, b"\0")))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                cols = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(cols, ["akey", "none", "id", "h", "pos", "nl", "nr", "left", "right"])

    return near.mapInArrow(_joined(run, 1 << 13), "akey long, none int, id long, h int, pos int, nl int, nr int, left binary, right binary")


def string_by_string(around: DataFrame) -> DataFrame:
    """Repeats among the strings around these anchors, each string by its hash: more rows, but no group is gathered."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            none, doc_id, h, pos, nl, nr = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(1, 7))
            out = []
            for i, text in enumerate(x + y for x, y in zip(b.column(7).to_pylist(), b.column(8).to_pylist())):
                for p in range(SIDE - int(nl[i]), min(SIDE, int(nr[i]) - ANCHOR) + 1):
                    digest = xxhash.xxh3_128_intdigest(text[p : p + LENGTH])
                    out.append((digest >> 64, digest & 0xFFFFFFFFFFFFFFFF, none[i], doc_id[i], h[i], pos[i] - SIDE + p))
            if out:
                first, second, *rest = zip(*out)
                cols = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in (first, second)]
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([*cols, *(pa.array(c, t) for c, t in zip(rest, kinds))], ["a", "b", "none", "id", "h", "start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            if rows.shape[1] == 0:
                continue
            if carry is not None:
                rows = np.concatenate([carry[:, None], rows], axis=1)
            new = np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)])
            first = np.maximum.accumulate(np.where(new, np.arange(rows.shape[1]), 0))
            again = ~new & (rows[2:] != rows[2:, first]).any(axis=0)
            yield _found(rows[2:5, again], rows[5, again], rows[5, again] + LENGTH)
            carry = rows[:, first[-1]].copy()

    listed = around.mapInArrow(_joined(cut), "a long, b long, none int, id long, h int, start int").repartition("a", "b")
    return listed.sortWithinPartitions("a", "b", "none", "id", "h", "start").mapInArrow(_joined(run), from_arrow_schema(_FOUND))


def induced(around: DataFrame) -> DataFrame:
    """Repeats among anchors whose surroundings differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            if b.num_rows == 0:
                continue
            akey = b.column(0).to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(akey != akey[-1])
            cut = int(cut[-1]) + 1 if len(cut) else 0  # the last anchor may go on
            if kept and kept[-1].column(0)[kept[-1].num_rows - 1].as_py() != int(akey[0]) and size >= ROWS:
                yield repeats_of(kept)
                kept, size = [], 0
            if cut and size + cut >= ROWS:
                yield repeats_of([*kept, b.slice(0, cut)])
                kept, size, b = [], 0, b.slice(cut)
            kept.append(b)
            size += b.num_rows
        if kept:
            yield repeats_of(kept)

    sorted_rows = around.repartition("akey").sortWithinPartitions("akey", "right", "none", "id", "h", "pos")
    return sorted_rows.mapInArrow(run, from_arrow_schema(_FOUND))


def repeats_of(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The repeated stretch around each anchor; rows by anchor, then by what follows it."""
    t = pa.Table.from_batches(batches).combine_chunks()
    rows = np.stack([t[c].to_numpy().astype(np.int64) for c in ("akey", "none", "id", "h", "pos", "nl", "nr")])
    m = rows.shape[1]
    left, right = (np.frombuffer(b"".join(t[c].to_pylist()), np.uint8).reshape(m, -1) for c in ("left", "right"))
    # common prefixes of neighbours in the sorted order; none between anchors
    differs = right[1:] != right[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), right.shape[1])
    common = np.concatenate([[-1], np.where(rows[0, 1:] == rows[0, :-1], common, -1)])
    first = np.lexsort((rows[4], rows[3], rows[2], rows[1]))  # by document and place
    low, high = np.full(m, SIDE + 1), np.full(m, -1)
    name = np.zeros(m, np.int64)  # of the bytes from p to the anchor
    for p in range(SIDE, -1, -1):
        if p < SIDE:
            _, name = np.unique(name * 256 + left[:, p], return_inverse=True)
        ends = np.cumsum(common < ANCHOR + p)  # equal for those with equal bytes up to the string's end
        whole = first[(rows[5, first] >= SIDE - p) & (rows[6, first] >= ANCHOR + p)]
        key = ends[whole] * (m + 1) + name[whole]
        order = np.argsort(key, kind="stable")
        again = np.flatnonzero(np.concatenate([[False], key[order][1:] == key[order][:-1]])) if len(order) else order
        later = whole[order[again]]
        low[later] = np.minimum(low[later], p)
        high[later] = np.maximum(high[later], p)
    hit = np.flatnonzero(high >= 0)
    # stretches of one row overlap: strings are longer than the anchor's reach
    begin = rows[4, hit] - SIDE
    return _found(rows[1:4, hit], begin + low[hit], begin + high[hit] + LENGTH)


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of `docs` (doc_id, text).

    A byte goes if a 100-byte string over it starts earlier too, in a smaller doc_id
    (NULL after all) or earlier in the document. Rows with the same id are ordered by
    a hash of their texts; repeated rows count as one document and get the same
    result. NULL texts count as empty. Other columns aren't read.
    """
    documents = _documents(docs)
    once = stage(compared(occurrences(documents)), "substrings-compared")
    asked = once.where("akey IS NOT NULL")
    large = asked.groupBy("akey").agg(F.count("*").alias("rows")).where(F.col("rows") > LARGE).select("akey")
    large = stage(large, "substrings-large")
    around = stage(surroundings(documents, asked), "substrings-around", "zstd")
    usual, rest = around.join(large, "akey", "left_anti"), around.join(large, "akey", "left_semi")
    more = stage(induced(usual).union(string_by_string(rest)), "substrings-induced")
    spans = once.where("akey IS NULL").union(more)
    each = stage(
        spans.groupBy("none", "id", "h").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "substrings-spans"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for none, doc_id, text, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                raw = memoryview(text.as_buffer() or b"")
                gone, sha, at = merged([(s["start"], s["stop"]) for s in spans or ()]), hashlib.sha256(), 0
                for s, e in gone:
                    sha.update(raw[at:s])
                    at = e
                sha.update(raw[at:])
                rows.append((None if none else doc_id, len(raw), sum(e - s for s, e in gone), len(gone), sha.hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RESULT)], schema=RESULT)

    held = _among(documents, each).join(each, ["none", "id", "h"], "left").select("none", "id", "text", "spans")
    free = _among(documents, each, inside=False).select("none", "id", "text", F.lit(None).cast(each.schema["spans"].dataType).alias("spans"))
    schema = from_arrow_schema(RESULT)
    return held.mapInArrow(run, schema).union(free.mapInArrow(run, schema))
