"""Near-equal paragraphs across documents: MinHash bands, exact Jaccard, components.

A paragraph is a line, or short ones in a row. Its words are lower-cased runs of letters and digits, its
set is that of its 5-word shingles. Equal paragraphs share an id (a hash of their
words), and only different ones go on: their MinHash signature is cut into bands,
those that collide in a band are compared by the exact Jaccard of their shingles,
and what reaches the threshold is clustered by connected components. Small buckets
of a band list their pairs. The members of a large one meet in blocks, every two
blocks once, where overlaps with one line are counted over all others together,
and only links that span the groups leave: none is lost, and pairs aren't written.

Neighbouring lines too short for a paragraph, as in hard-wrapped text, are one together.

A passage may also stand inside a longer line, or run over line ends. So runs of
`RUN` words take part with their ids, wherever the least hash of some `ANCHOR` shingles
in a row stands: any `ANCHOR + RUN - 1` equal words hold the same run, whatever is around them.
And a line of several sentences is cut after about every other one, by a hash of the sentence itself, in `CUTS` ways, and
these pieces take part with their ids alone: too short for an edit to leave 0.8 of
their shingles.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thalweg.llm.components import components
from thalweg.staging import stage

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
#: Words of a line, and of a piece of one, that take part; shorter ones are headings and boilerplate.
LINE_WORDS = 20
PIECE_WORDS = 12
#: Ways to cut a line into pieces, each by another bit of the sentences' hashes.
CUTS = 2
#: Shingles of which the least starts a run, and words of a run.
ANCHOR, RUN = 25, 26
#: A bucket of up to so many different paragraphs lists its pairs.
SMALL = 32
#: Paragraphs of a large bucket's block; two blocks are in memory at a time.
BLOCK = 2048
#: Classes of over `HOT` places, the largest `MOST_HOT` of them, reach all tasks, instead of all their places one task.
HOT, MOST_HOT = 1000, 10_000
#: Characters of texts read together, unless one text is longer, and words hashed together.
STEP, WORDS = 1 << 20, 1 << 17
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_WORD = re.compile(r"[^\W_]+")
#: After these characters, before white space, a sentence ends.
_STOPS = np.array([ord(c) for c in ".?!"], np.uint32)


def tuned(similarity: float, recall: float, most: int = 64) -> tuple[int, int]:
    """Bands and rows per band: the most rows, so the fewest chance meetings, that reach the recall within `most` hashes."""
    for rows in range(most, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(similarity**rows)))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no number of bands within this many hashes reaches the recall")


BANDS, ROWS = tuned(SIMILARITY, RECALL)
_ODD = np.random.default_rng(9).integers(1 << 62, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: What `_MIX` times it is 1, in 64 bits.
_BACK = np.uint64(pow(int(_MIX), -1, 1 << 64))


@cache
def _kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point: is it a letter or digit, is it white space, its lower case (itself where that is several)."""
    each = [chr(c) for c in range(0x110000)]
    lower = np.fromiter((ord(x) if len(x := c.lower()) == 1 else i for i, c in enumerate(each)), np.uint32, len(each))
    return np.fromiter(map(str.isalnum, each), bool, len(each)), np.fromiter(map(str.isspace, each), bool, len(each)), lower


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each word: the sum of its characters' hashes, which tell their places in it."""
    out = np.empty(len(starts), np.uint64)
    lower = _kinds()[2]
    for i in range(0, len(starts), WORDS):
        size = stops[i : i + WORDS] - starts[i : i + WORDS]
        first = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(first, size)
        x = lower[codes[np.repeat(starts[i : i + WORDS], size) + at]].astype(np.uint64)
        x = (x | (at.astype(np.uint64) << np.uint64(21))) * _MIX
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out[i : i + WORDS] = np.add.reduceat(x ^ (x >> np.uint64(32)), first)
    return _mixed(out)


class _Words:
    """The words of some texts, with hashes of any words in a row from one pass over them."""

    def __init__(self, texts: list[str]) -> None:
        whole = "\n".join(texts)
        self.codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.base = np.cumsum([0, *(len(t) + 1 for t in texts)])
        inside = np.zeros(len(self.codes) + 2, np.int8)
        inside[1:-1] = _kinds()[0][self.codes]
        turn = np.diff(inside)
        self.starts, self.stops = np.flatnonzero(turn > 0), np.flatnonzero(turn < 0)
        self.hashes = _word_hashes(self.codes, self.starts, self.stops)
        n = len(self.hashes)
        power = np.full(n, _MIX)
        back = np.full(n + 1, _BACK)
        power[:1], back[:1] = 1, 1
        self.back = np.multiply.accumulate(back)  # negative powers, so that a row's hash doesn't tell its place
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * np.multiply.accumulate(power), dtype=np.uint64)])
        s = self.hashes[: max(n - SHINGLE + 1, 0)].copy()
        for k in range(1, SHINGLE):
            s = (s ^ (s >> np.uint64(31))) * _MIX + self.hashes[k : n - SHINGLE + 1 + k]
        self.shingles = s ^ (s >> np.uint64(32))

    def before(self, at: np.ndarray) -> np.ndarray:
        """The number of words that start before these characters."""
        return np.searchsorted(self.starts, at)

    def ids(self, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
        """Hashes of the words from a[i] to b[i]."""
        return _mixed((self.sums[b] - self.sums[a]) * self.back[a] + (b - a).astype(np.uint64) * _MIX + np.uint64(level))

    def paragraphs(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends (characters): lines of enough words, and shorter ones joined until a long or a wordless one."""
        ends = np.append(np.flatnonzero(self.codes == 10), len(self.codes))
        starts = np.concatenate([[0], ends[:-1] + 1])
        n = np.diff(self.before(np.append(starts, len(self.codes) + 1)))
        short = (n > 0) & (n < LINE_WORDS)
        on = short[1:] & short[:-1] & ~np.isin(starts[1:], self.base)  # goes on the line before it
        s = starts[(n > 0) & ~np.concatenate([[False], on])]
        e = ends[(n > 0) & ~np.concatenate([on, [False]])]
        enough = self.before(e) - self.before(s) >= LINE_WORDS
        return s[enough], e[enough]

    def pieces(self, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces with enough words, but for whole paragraphs."""
        space = np.concatenate([[False], _kinds()[1][self.codes], [False]])
        turn = np.diff(space.astype(np.int8))
        x, y = np.flatnonzero(turn > 0), np.flatnonzero(turn < 0)
        ok = x > 0
        ok[ok] = np.isin(self.codes[x[ok] - 1], _STOPS)
        x, y = x[ok], y[ok]
        of = np.searchsorted(s, x, "right") - 1
        ok = (of >= 0) & (x < e[of]) if len(e) else np.zeros(len(x), bool)
        x, y, of = x[ok], np.minimum(y[ok], e[of[ok]]), of[ok]
        new = np.concatenate([[True], of[1:] != of[:-1]])[: len(of)]
        since = np.where(new, s[of], np.concatenate([[0], y[:-1]])[: len(of)])
        bits = self.ids(self.before(since), self.before(x), 3)
        found = np.empty((0, 2), np.int64)
        for way in range(CUTS):
            cut = (bits >> np.uint64(way)) & np.uint64(1) > 0
            found = np.concatenate([found, np.stack([np.sort(np.concatenate([s, y[cut]])), np.sort(np.concatenate([x[cut], e]))], axis=1)])
        found = np.unique(found, axis=0) if len(found) else found
        at = np.searchsorted(s, found[:, 0]).clip(max=max(len(s) - 1, 0))
        some = self.before(found[:, 1]) - self.before(found[:, 0]) >= PIECE_WORDS
        if len(s):
            some &= (s[at] != found[:, 0]) | (e[at] != found[:, 1])
        return found[some, 0], found[some, 1]

    def runs(self) -> np.ndarray:
        """First words of the runs, over line ends; of equal ones of a text that overlap the first."""
        n = len(self.hashes)
        if n < ANCHOR + RUN - 1:
            return np.empty(0, np.int64)
        bound = self.before(self.base)
        # the hash's upper bits, then the place: the least of a window is the first of the least shingles
        at = np.arange(len(self.shingles), dtype=np.uint64)
        low = self.shingles >> np.uint64(32) << np.uint64(32) | at
        width = 1
        while 2 * width <= ANCHOR:
            low, width = np.minimum(low[:-width], low[width:]), 2 * width
        low = np.minimum(low[: len(self.shingles) - ANCHOR + 1], low[ANCHOR - width :])
        text = np.searchsorted(bound, np.arange(n), "right")
        window = np.arange(len(low))
        size = np.diff(bound)
        inside = (text[window] == text[window + ANCHOR + SHINGLE - 2]) & (size[text[window] - 1] >= ANCHOR + RUN - 1)
        starts = (low[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = starts[np.concatenate([[True], starts[1:] != starts[:-1]])[: len(starts)]]
        starts = starts[starts + RUN <= bound[text[starts]]]
        names = self.ids(starts, starts + RUN, 2)
        order = np.lexsort((starts, names, text[starts]))
        same = (names[order][1:] == names[order][:-1]) & (np.diff(starts[order]) < RUN) & (np.diff(text[starts[order]]) == 0)
        near, gone, last = np.flatnonzero(same), [], -1
        for i in near.tolist():  # only where equal runs overlap
            if i == 0 or not same[i - 1]:
                last = starts[order[i]]
            if starts[order[i + 1]] - last < RUN:
                gone.append(order[i + 1])
            else:
                last = starts[order[i + 1]]
        return np.delete(starts, gone)


def units(texts: list[str]) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(level, text numbers, starts, ends, ids, bands) of paragraphs (0, the only ones with bands), their pieces (1) and runs (2)."""
    words = _Words(texts)
    s, e = words.paragraphs()
    a, b = words.before(s), words.before(e)
    n = b - a - SHINGLE + 1
    first = np.cumsum(n) - n
    ids = words.ids(a, b, 0)
    each = words.shingles[np.arange(int(n.sum())) - np.repeat(first - a, n)]
    found = [(0, s, e, ids, bands(each, n))]
    s, e = words.pieces(s, e)
    found.append((1, s, e, words.ids(words.before(s), words.before(e), 1), None))
    i = words.runs()
    found.append((2, words.starts[i], words.stops[i + RUN - 1], words.ids(i, i + RUN, 2), None))
    out = []
    for level, s, e, ids, band in found:
        text = np.searchsorted(words.base, s, "right") - 1
        out.append((level, text, s - words.base[text], e - words.base[text], ids.view(np.int64), band))
    return out


def _shingles(many: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """The shingles' hashes of lists of at least `SHINGLE` words, one list after the other, and how many each has."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for words in many for w in words), np.uint64, sum(map(len, many)))
    s = h[: len(h) - SHINGLE + 1].copy()
    for k in range(1, SHINGLE):
        s = (s ^ (s >> np.uint64(31))) * _MIX + h[k : len(h) - SHINGLE + 1 + k]
    s ^= s >> np.uint64(32)
    sizes = np.array([len(words) for words in many])
    ends = np.cumsum(sizes)
    # up to each end the last shingles would run into the next list
    ok = np.ones(len(h), bool)
    for k in range(1, SHINGLE):
        ok[ends - k] = False
    return s[ok[: len(s)]], sizes - SHINGLE + 1


def bands(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The band hashes (signed) of sets of shingles' hashes, one after the other, of these sizes."""
    starts = np.cumsum(sizes) - sizes
    out = np.zeros((len(sizes), BANDS), np.uint64)
    if len(sizes):
        for b in range(BANDS):
            for r in range(ROWS):
                least = np.minimum.reduceat((shingles * _ODD[b * ROWS + r]) >> np.uint64(16), starts)
                out[:, b] = (out[:, b] ^ (out[:, b] >> np.uint64(29))) * _MIX + least
            out[:, b] = (out[:, b] ^ (out[:, b] >> np.uint64(32))) * _MIX + np.uint64(b)
    return out.view(np.int64)


UNITS = "doc_id long, h int, level int, start int, stop int, uid long, line string, bands array<long>"


def scan(docs: DataFrame) -> DataFrame:
    """A row per unit of every document (doc_id, text); lines carry their text and bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, texts, size = 0, [], 0
            for i, text in enumerate(b.column(2), 1):
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size > STEP or i == b.num_rows:
                    yield from _rows(b.slice(first, i - first), texts)
                    first, texts, size = i, [], 0

    key = F.hash(F.coalesce("text", F.lit("")))  # tells rows of the same id apart
    return docs.select("doc_id", key.alias("h"), "text").mapInArrow(run, UNITS)


def _rows(docs: pa.RecordBatch, texts: list[str]) -> Iterator[pa.RecordBatch]:
    for level, text, start, stop, uid, band in units(texts):
        n = len(text)
        lines = [texts[t][s:e] for t, s, e in zip(text.tolist(), start.tolist(), stop.tolist())] if level == 0 else pa.nulls(n, pa.string())
        lists = pa.nulls(n, pa.list_(pa.int64()))
        if level == 0:
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(band.ravel()))
        cols = [
            docs.column(0).take(pa.array(text)),
            docs.column(1).take(pa.array(text)),
            pa.array(np.full(n, level), pa.int32()),
            pa.array(start, pa.int32()),
            pa.array(stop, pa.int32()),
            pa.array(uid),
            pa.array(lines, pa.string()) if level == 0 else lines,
            lists,
        ]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "h", "level", "start", "stop", "uid", "line", "bands"])


def candidates(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a < b) of ids of different lines that share a small bucket, and the members (band, uid, block) of large ones."""
    listed = scanned.where("level = 0").select("uid", "bands").dropDuplicates(["uid"])
    listed = listed.select(F.explode("bands").alias("band"), "uid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, large, n = np.empty((2, 0), np.int64), None, 0
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if large is not None:  # the bucket before it goes on
                k = int((rows[0] == large).sum())
                yield _members(rows[:, :k], n)
                n += k
                if k == rows.shape[1]:
                    continue
                rows, large = rows[:, k:], None
            rows = np.concatenate([rest, rows], axis=1)
            new = np.flatnonzero(rows[0, 1:] != rows[0, :-1]) + 1
            last = int(new[-1]) if len(new) else 0
            yield from _met(rows[:, :last])
            rest = rows[:, last:]
            if rest.shape[1] > SMALL:
                large, n = int(rest[0, 0]), rest.shape[1]
                yield _members(rest, 0)
                rest = rest[:, :0]
        yield from _met(rest)

    met = listed.repartition("band").sortWithinPartitions("band", "uid").mapInArrow(run, "a long, b long, block long")
    met = stage(met, "paragraph-met", "zstd")
    return met.where("block IS NULL").select("a", "b").distinct(), met.where("block IS NOT NULL").select(F.col("a").alias("band"), F.col("b").alias("uid"), "block")


def _members(rows: np.ndarray, at: int) -> pa.RecordBatch:
    """Members (band, uid) of a large bucket, from its member number `at` on, with their blocks."""
    block = (at + np.arange(rows.shape[1])) // BLOCK
    return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), pa.array(block)], ["a", "b", "block"])


def _met(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For whole buckets (band, uid): pairs of small ones, members of large ones."""
    if rows.shape[1] < 2:
        return
    starts = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]))
    sizes = np.diff(np.append(starts, rows.shape[1]))
    for batch in _pairs(rows[:, np.repeat(sizes <= SMALL, sizes)]):
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, pa.int64())], ["a", "b", "block"])
    for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        yield _members(rows[:, s : s + n], 0)


def _pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """All pairs of whole buckets (band, uid) of up to `SMALL`."""
    new = np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])[: rows.shape[1]]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, rows.shape[1]))
    left = np.repeat(starts + sizes, sizes) - np.arange(rows.shape[1])
    for d in range(1, SMALL):
        i = np.flatnonzero(left > d)
        if not len(i):
            break
        yield pa.RecordBatch.from_arrays([pa.array(rows[1, i]), pa.array(rows[1, i + d])], ["a", "b"])


def jaccard(a: list[str], b: list[str]) -> float:
    x, y = ({tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)} for w in (a, b))
    return len(x & y) / len(x | y) if x or y else 1.0


def collided(scanned: DataFrame, pairs: DataFrame, members: DataFrame) -> DataFrame:
    """uid and line, once each, of what is in a pair or in a large bucket; all texts move only for this."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("uid")).union(members.select("uid")).distinct()
    own = scanned.where("level = 0").select("uid", "line").join(needed, "uid", "left_semi").dropDuplicates(["uid"])
    return stage(own, "paragraph-lines", "zstd")


def verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs whose exact Jaccard reaches the threshold; lines: uid, line of all in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = [
                jaccard(*(_WORD.findall(t.lower()) for t in pair)) >= SIMILARITY
                for pair in zip(b.column(2).to_pylist(), b.column(3).to_pylist())
            ]
            yield b.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    first = lines.select(F.col("uid").alias("a"), F.col("line").alias("x"))
    second = lines.select(F.col("uid").alias("b"), F.col("line").alias("y"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def linked(members: DataFrame, lines: DataFrame) -> DataFrame:
    """Links (a, b) that span the groups of lines whose exact Jaccard reaches the threshold, of large buckets (band, uid, block)."""
    blocks = members.groupBy("band").agg((F.max("block") + 1).alias("blocks"))
    # every two blocks of a bucket meet; the pair also settles what is within each
    others = F.expr("filter(sequence(0L, blocks - 1), j -> j != block)")
    meets = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(others, lambda j: F.least(j, "block") * F.col("blocks") + F.greatest(j, "block"))
    )
    each = members.join(blocks, "band").select("band", "uid", F.explode(meets).alias("meet")).join(lines.select("uid", "line"), "uid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, uids, texts = None, [], []
        for b in batches:
            for band, meet, uid, text in zip(*(c.to_pylist() for c in b.columns)):
                if (band, meet) != now:
                    yield _links(uids, texts)
                    now, uids, texts = (band, meet), [], []
                uids.append(uid)
                texts.append(text)
        yield _links(uids, texts)

    by = ["band", "meet"]
    return each.select(*by, "uid", "line").repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a long, b long").distinct()


def _links(uids: list[int], texts: list[str]) -> pa.RecordBatch:
    found = spanned([_WORD.findall(t.lower()) for t in texts])
    ids = np.array(uids, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(*ids[found])), pa.array(np.maximum(*ids[found]))], ["a", "b"])


def spanned(many: list[list[str]]) -> np.ndarray:
    """Positions (2, links) of links from the first of each group of lists to the others.

    Lists whose exact Jaccard reaches the threshold are linked, and a group is what
    is connected. Each list taken into a group meets all those in none yet, by
    counting over the lists of its shingles: as many steps as pairs share shingles, at worst.
    """
    if len(many) < 2:
        return np.empty((2, 0), np.int64)
    s, n = _shingles(many)
    names, s = np.unique(s, return_inverse=True)
    once = np.unique(np.repeat(np.arange(len(many)), n) * len(names) + s)
    owner, s = once // len(names), once % len(names)
    size = np.bincount(owner, minlength=len(many))
    first = np.cumsum(size) - size
    holders = owner[np.argsort(s, kind="stable")]
    held = np.bincount(s, minlength=len(names))
    starts = np.cumsum(held) - held
    free = np.ones(len(many), bool)
    heads, others = [], []
    for head in range(len(many)):
        if not free[head]:
            continue
        free[head], todo = False, [head]
        while todo and free.any():
            x = todo.pop()
            own = s[first[x] : first[x] + size[x]]
            own = own[held[own] > 1].tolist()
            if not own:
                continue
            shared = np.bincount(np.concatenate([holders[starts[k] : starts[k] + held[k]] for k in own]), minlength=len(many))
            near = np.flatnonzero(free & (shared / (size + size[x] - shared) >= SIMILARITY))
            free[near] = False
            todo += near.tolist()
            heads += [head] * len(near)
            others += near.tolist()
    return np.array([heads, others], np.int64)


def _with_roots(labels: DataFrame) -> DataFrame:
    """uid and cls of every labelled node and of the smallest nodes they are labelled with."""
    roots = labels.select(F.col("label").alias("uid"), F.col("label").alias("cls")).distinct()
    return labels.select(F.col("node").alias("uid"), F.col("label").alias("cls")).union(roots)


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a job go when it ends, not when the driver happens to collect its garbage.

    For steps that stage what they make: a frame that runs twice shuffles again. Holds for
    the whole session meanwhile, where it changes no result.
    """
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def _held(docs: DataFrame) -> DataFrame:
    """The places (cls, doc_id, h, start, stop, place) of paragraphs, pieces and runs that share an id or a class."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = stage(scan(docs), "paragraphs", "zstd")
    pairs, members = candidates(scanned)
    pairs = stage(pairs, "paragraph-pairs")
    lines = collided(scanned, pairs, members)
    near = verified(pairs, lines).union(linked(members, lines))
    labels = components(stage(near, "paragraph-edges"))
    places = scanned.select("doc_id", "h", "start", "stop", "uid")
    # most ids have one place and no class, and go no further than this count
    own = places.groupBy("uid").agg(F.count("*").alias("n")).join(_with_roots(labels), "uid", "left")
    own = own.where("cls IS NOT NULL OR n > 1").select("uid", F.coalesce("cls", "uid").alias("cls"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "start")
    held = places.join(stage(own, "paragraph-classes"), "uid").select("cls", "doc_id", "h", "start", "stop", place.alias("place"))
    return stage(held, "paragraph-places", "zstd")


def _with_first(held: DataFrame, kept: DataFrame) -> DataFrame:
    """The places of the classes kept (cls, first, n), with first; large classes stay spread as they are."""
    hot = F.broadcast(kept.where(F.col("n") > HOT).orderBy(F.desc("n"), "cls").limit(MOST_HOT).select("cls", "first"))
    rest = held.join(hot, "cls", "left_anti").join(kept.select("cls", "first"), "cls")
    return held.join(hot, "cls").unionByName(rest)


def repeats(docs: DataFrame) -> DataFrame:
    """One row for each document that holds a paragraph of a class of two or more.

    doc_id; n_repeated, its paragraphs, pieces and runs in such classes; n_removed, the
    separate stretches of text that another document or place keeps; removed_chars;
    removed, these stretches as start:end, joined; kept_in, the ids of the documents
    that keep them, in order; class_id, the smallest of those and its own.

    A class keeps its first place by (doc_id, start), NULL ids last. Repeated rows
    (same id and text) count as one document. NULL and empty texts, and lines of
    fewer than 20 words with their short neighbours, hold no paragraph. Other columns aren't read.
    """
    with _shuffles_freed(docs.sparkSession):
        held = _held(docs)
        # repeated rows alone are one place
        kept = held.groupBy("cls").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.count("*").alias("n")).where("first != last")
        kept = stage(kept.select("cls", "first", "n"), "paragraph-kept", "zstd")
    held = _with_first(held, kept).withColumn("gone", F.col("place") != F.col("first"))
    span = F.when(F.col("gone"), F.struct("start", "stop"))
    each = held.groupBy("doc_id", "h").agg(
        F.countDistinct("start", "stop").alias("n_repeated"),
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.collect_set(F.when(F.col("gone"), F.col("first.doc_id")))).alias("kept_in"),
    )
    merged = F.expr(
        "aggregate(spans, cast(array() as array<struct<start:int,stop:int>>), (done, s) -> "
        "if(size(done) > 0 and element_at(done, -1).stop >= s.start, "
        "concat(slice(done, 1, size(done) - 1), array(struct(element_at(done, -1).start as start, greatest(element_at(done, -1).stop, s.stop) as stop))), "
        "concat(done, array(s))))"
    )
    return each.withColumn("spans", merged).select(
        "doc_id",
        "n_repeated",
        F.size("spans").alias("n_removed"),
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)").alias("removed_chars"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.start, s.stop)), ",").alias("removed"),
        "kept_in",
        F.least("doc_id", F.array_min("kept_in")).alias("class_id"),
    )
