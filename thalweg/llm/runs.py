"""Runs of words that repeat with a period, found by splitting texts at rare words.

A run holds each of its words at least four times (and at least six if the period is
one), so a word that occurs less often within its segment is in no run of that
segment: it splits it. What is left is counted and split again until nothing
changes, which leaves little of ordinary prose. The surviving segments are scanned
lag by lag: a run of lag q covers a place that is a multiple of q with 2q equal
words behind it, so only those places are looked at, n/q for each lag, by hashes of
stretches. That makes the scan n log n, whatever the text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: how often a run repeats its period, and its least length.
REPEATS, LEAST = 4, 6
#: Bytes of text, and words, that are handled in one go.
STEP = 1 << 22
#: An odd multiplier; stretches are hashed by polynomials modulo 2**64.
_BASE = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>"
)


def words(text: str | None) -> tuple[np.ndarray, list[bytes]]:
    """The words' numbers, and the distinct words by number."""
    data = (text or "").encode("utf-8", "surrogatepass")
    known: dict[bytes, int] = {}
    parts, at = [], 0
    while at < len(data):
        to = at + STEP
        while to < len(data) and not data[to : to + 1].isspace():
            to += 1
        some = data[at:to].split()
        parts.append(np.fromiter((known.setdefault(w, len(known)) for w in some), np.int32, len(some)))
        at = to
    return np.concatenate(parts) if parts else np.empty(0, np.int32), list(known)


def altered(codes: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The words after the contract's change: every tenth id by checksum repeats its end. A NULL id doesn't."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(codes)
    if h % 10 or not n:
        return codes
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([codes[:a], codes[a + np.arange(n - a) % p]])


def segments(codes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end) that hold all runs, and every word of theirs often enough to be in one."""
    at, segment, own = np.arange(len(codes)), np.zeros(len(codes), np.int64), codes.astype(np.int64)
    while len(at):
        key = segment * (int(own.max()) + 1) + own
        _, which, counts = np.unique(key, return_inverse=True, return_counts=True)
        often = counts[which] >= REPEATS
        kept, before = at[often], segment[often]
        new = np.ones(len(kept), bool)
        new[1:] = (np.diff(kept) != 1) | (np.diff(before) != 0)
        segment = np.cumsum(new) - 1
        long = np.bincount(segment, minlength=1)[segment] >= LEAST if len(kept) else np.empty(0, bool)
        stable = often.all() and long.all()
        at, segment = kept[long], segment[long]
        own = codes[at].astype(np.int64)
        if stable:
            break
    if not len(at):
        return []
    cuts = np.flatnonzero(np.diff(segment)) + 1
    return list(zip(at[np.concatenate([[0], cuts])].tolist(), (at[np.concatenate([cuts - 1, [len(at) - 1]])] + 1).tolist()))


def find_runs(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs as (start, length, period), by start, then period."""
    found = []
    for start, end in segments(codes):
        found += [(start + s, n, q) for s, n, q in _scan(codes[start:end])]
    return sorted(found, key=lambda r: (r[0], r[2]))


def _scan(w: np.ndarray) -> Iterator[tuple[int, int, int]]:
    n = len(w)
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE)]))
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((w.astype(np.uint64) + np.uint64(1)) * power[:n])])
    covered = np.zeros(n + 1, np.int64)  # where the farthest run found so far that holds a place ends
    for q in range(1, n // REPEATS + 1):
        at = np.arange(0, n - 3 * q + 1, q)
        if q > 1:  # inside a run of a smaller period, a larger one can't be the smallest
            at = at[covered[at] < at + 3 * q]
        ahead = (prefix[at + 2 * q] - prefix[at]) * power[q]
        hits = at[ahead == prefix[at + 3 * q] - prefix[at + q]]
        done = -1
        for j in hits.tolist():
            if j < done:
                continue
            s, e = _extended(w, j, q)
            done = e - q + 1
            if e - s >= max(LEAST, REPEATS * q):
                covered[s:e] = np.maximum(covered[s:e], e)
                yield s, e - s, q


def _extended(w: np.ndarray, j: int, q: int) -> tuple[int, int]:
    """The longest stretch around `j` in which words `q` apart are equal."""
    n, size, to = len(w), 64, j
    while to + q < n:
        end = min(to + size, n - q)
        differ = np.flatnonzero(w[to:end] != w[to + q : end + q])
        if len(differ):
            to += int(differ[0])
            break
        to, size = end, 2 * size
    size, start = 64, j
    while start > 0:
        low = max(0, start - size)
        differ = np.flatnonzero(w[low:start] != w[low + q : start + q])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start, size = low, 2 * size
    return start, to + q


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words some run holds after its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges)[:n] > 0


def _collapsed(codes: np.ndarray, distinct: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    kept = codes[~dropped(len(codes), runs)] if runs else codes
    digest = hashlib.sha256()
    for at in range(0, len(kept), STEP):
        digest.update((b" " if at else b"") + b" ".join([distinct[c] for c in kept[at : at + STEP].tolist()]))
    return digest.hexdigest()


def judge(doc_id: int | None, text: str | None, change: bool = True) -> tuple:
    """A row of `SCHEMA`."""
    codes, distinct = words(text)
    if change:
        codes = altered(codes, doc_id)
    runs = find_runs(codes)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    longest = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    best = (*longest, 1000 * longest[1] // longest[2]) if longest else (None,) * 4
    spans = [{"start": s, "length": n, "period": q} for s, n, q in runs]
    return doc_id, len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), _collapsed(codes, distinct, runs), spans


def periodic(docs: DataFrame, change: bool = False) -> DataFrame:
    """A row of `SCHEMA` for every row of `docs`: its runs, the longest one, and the text without repeats.

    `change` alters every tenth document first, as `altered` says. NULL and empty texts, and
    those of white space, have no word and no run, and the hashes of empty text. Equal lengths: the
    run that starts first, then the smaller period. Repeated rows and NULL ids stay; an empty table gives
    an empty result. Other columns aren't read. Texts are whole, of any length; a word, and the
    distinct words of one text, must fit in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.partition(" ")[0] for c in SCHEMA.split(", ", 8)]
        kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))]
        for b in batches:
            # row by row, so that a batch of long texts isn't held as objects at once
            rows = [judge(d.as_py(), t.as_py(), change) for d, t in zip(b.column(0), b.column(1))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, SCHEMA)
