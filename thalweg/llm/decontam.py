"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap.

The terms are pairs of neighbouring words. The inverted index holds, per term, the
items that have it in order, with BM25 impacts divided by the item's score for its
own text, and the largest impact of every block of postings. Every passage of every
document is a query: windows of twice the longest item's length, at steps of once
that length, so that no item's copy is split. All items at or above the threshold
are retrieved; WAND's first step (do the terms' largest impacts reach it at all?)
is taken for all windows of a batch at once. What is retrieved is verified by
the shares of the question's and the answer's 5-word shingles found in the window.

Items of fewer than 5 words are found where all their words stand in a row. A
benchmark too large for one index is indexed part by part, with document frequencies
and lengths that Spark counts over the whole of it, so that scores are the same.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from thalweg.staging import stage

K1, B = 1.2, 0.75
#: Share of an item's own score that a window must reach to be looked at.
THRESHOLD = 0.3
SHINGLE = 5
#: A copy: this share of the question and of the answer, or the second share of all.
PART, WHOLE = 0.5, 0.8
BLOCK = 16
#: Characters of the benchmark that one index holds, or about half of them where more take several.
MOST_CHARACTERS = 64_000_000
STEP = 1 << 20

_WORD = re.compile(r"[^\W_]+")
_SENTENCE_END = re.compile(r"[.?!]\s+(?=\S)|\n+(?=\S)")


@dataclass
class Index:
    vocabulary: dict[str, int]  # from 1
    keys: np.ndarray  # of the pairs, sorted
    most: np.ndarray  # by pair: the largest impact
    postings: list[tuple[np.ndarray, np.ndarray]]  # by pair: items, impacts
    blocks: list[tuple[np.ndarray, np.ndarray]]  # by pair: last item and largest impact of each block
    item_ids: list[int | None]  # those of `SHINGLE` words and more, then shorter ones
    questions: list[set]
    answers: list[set]
    stride: int
    steps: np.ndarray  # of the shorter items' tree of words: node and next word, sorted
    nodes: np.ndarray  # by step: the node it leads to
    ends: dict[int, list[int]]  # by node: the items that end there


@dataclass(frozen=True)
class Counts:
    """What the scores of a part need to know of the whole benchmark."""

    items: int
    mean: float
    stride: int
    held: dict[str, int]  # by pair of words of the part: the items that have it


def _words(text: str) -> Iterator[list[str]]:
    """The words, of about `STEP` characters at a time; cut between words."""
    at = 0
    while at < len(text):
        to = at + STEP
        while to < len(text) and text[to].isalnum():
            to += 1
        yield _WORD.findall(text[at:to].lower())
        at = to


def split(text: str) -> tuple[str, str]:
    """Question and answer: the last sentence is the answer, if there are two."""
    ends = [m.end() for m in _SENTENCE_END.finditer(text)]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, "")


def _shingles(ids: list[int]) -> set:
    n = min(SHINGLE, len(ids))
    return {tuple(ids[i : i + n]) for i in range(len(ids) - n + 1)} if n else set()


def _tree(short: list[list[int]], size: int, first: int) -> tuple[np.ndarray, np.ndarray, dict[int, list[int]]]:
    """Steps, nodes and ends (see `Index`) of short items, which are numbered from `first`."""
    to: dict[int, int] = {}
    ends: dict[int, list[int]] = {}
    for i, ids in enumerate(short, first):
        node = 0
        for w in ids:
            node = to.setdefault(node * size + w, len(to) + 1)
        ends.setdefault(node, []).append(i)
    steps = np.array(sorted(to), np.int64)
    return steps, np.array([to[s] for s in steps.tolist()], np.int64), ends


def build(items: list[tuple[int | None, str | None]], counts: Counts | None = None) -> Index:
    """Index items (id, text), the whole benchmark or, with its `counts`, a part. Those without a word can't be told and are left out."""
    vocabulary: dict[str, int] = {}
    kept, pairs, questions, answers, short = [], [], [], [], []
    for item_id, text in items:
        question, answer = (
            [vocabulary.setdefault(w, len(vocabulary) + 1) for part in _words(p) for w in part] for p in split(text or "")
        )
        ids = question + answer
        if len(ids) >= SHINGLE:
            kept.append((item_id, len(ids) - 1))
            pairs.append(Counter(zip(ids, ids[1:])))
            whole = _shingles(ids)
            questions.append(_shingles(question) & whole if len(question) >= SHINGLE else whole)
            answers.append(_shingles(answer))
        elif ids:
            short.append((item_id, ids))
    size = len(vocabulary) + 1
    if counts is None:
        n, held = len(kept), Counter(p for c in pairs for p in c)
        mean, stride = sum(x for _, x in kept) / max(n, 1), max((x + 1 for _, x in kept), default=1)
    else:
        n, mean, stride = counts.items, counts.mean, counts.stride
        held = {tuple(vocabulary[w] for w in p.split(" ")): c for p, c in counts.held.items()}
    lists: dict[tuple, list] = {p: [] for p in held}
    for i, c in enumerate(pairs):
        norm = K1 * (1 - B + B * kept[i][1] / mean)
        impact = {p: np.log1p((n - held[p] + 0.5) / (held[p] + 0.5)) * f * (K1 + 1) / (f + norm) for p, f in c.items()}
        own = sum(impact.values())
        for p, x in impact.items():
            lists[p].append((i, x / own))
    order = sorted(lists, key=lambda p: p[0] * size + p[1])
    postings, blocks = [], []
    for p in order:
        at, x = (np.array(v) for v in zip(*lists[p]))
        starts = np.arange(0, len(at), BLOCK)
        postings.append((at, x))
        blocks.append((at[np.minimum(starts + BLOCK, len(at)) - 1], np.maximum.reduceat(x, starts)))
    most = np.array([x.max() for _, x in postings])
    keys = np.array([a * size + b for a, b in order], np.int64)
    tree = _tree([ids for _, ids in short], size, len(kept))
    return Index(vocabulary, keys, most, postings, blocks, [i for i, _ in kept + short], questions, answers, stride, *tree)


def search(index: Index, terms: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
    """All items (position, score) whose impacts over these distinct terms reach the threshold, by block-max WAND."""
    cursors = [[0, t] for t in terms]
    end, found = len(index.item_ids), []

    def item(c: list[int]) -> int:
        at = index.postings[c[1]][0]
        return int(at[c[0]]) if c[0] < len(at) else end

    def forward(c: list[int], to: int) -> None:
        at = index.postings[c[1]][0]
        c[0] += int(np.searchsorted(at[c[0] :], to))

    while cursors:
        cursors = sorted((c for c in cursors if item(c) < end), key=item)
        bound, pivot = 0.0, None
        for i, c in enumerate(cursors):
            bound += index.most[c[1]]
            if bound >= threshold:
                pivot = i
                break
        if pivot is None:
            break
        at = item(cursors[pivot])
        while pivot + 1 < len(cursors) and item(cursors[pivot + 1]) == at:
            pivot += 1
        head, bound, to = cursors[: pivot + 1], 0.0, end
        for c in head:
            last, most = index.blocks[c[1]]
            block = int(np.searchsorted(last, at))
            if block < len(last):
                bound += most[block]
                to = min(to, int(last[block]) + 1)
        if bound < threshold:  # nothing up to the first of these blocks' ends can reach it
            if pivot + 1 < len(cursors):
                to = min(to, item(cursors[pivot + 1]))
            for c in head:
                forward(c, max(to, at + 1))
            continue
        parts = []
        for c in head:
            forward(c, at)
            if item(c) == at:
                parts.append(float(index.postings[c[1]][1][c[0]]))
                c[0] += 1
        score = math.fsum(parts)  # the same in any order of the terms
        if score >= threshold:
            found.append((at, score))
    return found


def matches(index: Index, text: str | None) -> dict[int, tuple[float, float, float, int]]:
    """By item position: score, question and answer overlap of the verified window with the largest score, and its first word."""
    if not text:
        return {}
    get = index.vocabulary.get
    w = np.concatenate([np.fromiter((get(x, 0) for x in part), np.int64, len(part)) for part in _words(text)])
    return _longer(index, w) | _shorter(index, w)


def _shorter(index: Index, w: np.ndarray) -> dict[int, tuple[float, float, float, int]]:
    """Items of fewer than `SHINGLE` words that stand in a row among `w`, at their first place."""
    found: dict[int, tuple[float, float, float, int]] = {}
    if not len(index.steps):
        return found
    size, at = len(index.vocabulary) + 1, np.arange(len(w))
    node = np.zeros(len(w), np.int64)
    for depth in range(SHINGLE - 1):
        inside = at + depth < len(w)
        at, node = at[inside], node[inside]
        key = node * size + w[at + depth]
        step = np.minimum(np.searchsorted(index.steps, key), len(index.steps) - 1)
        hit = index.steps[step] == key
        at, node = at[hit], index.nodes[step[hit]]
        for n, first in zip(*(x.tolist() for x in np.unique(node, return_index=True))):
            found |= {i: (1.0, 1.0, 1.0, int(at[first])) for i in index.ends.get(n, ())}
    return found


def _longer(index: Index, w: np.ndarray) -> dict[int, tuple[float, float, float, int]]:
    """Items of `SHINGLE` words and more that windows of `w` hold."""
    if not len(index.keys):
        return {}
    size = len(index.vocabulary) + 1
    pair = np.flatnonzero((w[:-1] > 0) & (w[1:] > 0))
    key = w[pair] * size + w[pair + 1]
    term = np.minimum(np.searchsorted(index.keys, key), len(index.keys) - 1)
    hit = index.keys[term] == key
    pair, term = pair[hit], term[hit]
    if not len(pair):
        return {}
    step = pair // index.stride
    bound = np.bincount(step, index.most[term], minlength=int(step[-1]) + 2)
    found: dict[int, tuple[float, float, float, int]] = {}
    for k in np.flatnonzero(bound[:-1] + bound[1:] >= THRESHOLD).tolist():
        near = slice(np.searchsorted(step, k), np.searchsorted(step, k + 2))
        retrieved = search(index, np.unique(term[near]).tolist())
        if retrieved:
            s = k * index.stride
            window = w[s : s + 2 * index.stride + 1].tolist()
            has = {n: {tuple(window[i : i + n]) for i in range(len(window) - n + 1)} for n in range(1, SHINGLE + 1)}
            for i, score in retrieved:
                q, a = (len([x for x in x_set if x in has[len(x)]]) for x_set in (index.questions[i], index.answers[i]))
                nq, na = len(index.questions[i]), len(index.answers[i])
                question, answer, whole = q / nq, a / na if na else q / nq, (q + a) / (nq + na)
                if (min(question, answer) >= PART or whole >= WHOLE) and (i not in found or score > found[i][0]):
                    found[i] = (score, question, answer, s)
    return found


def indexes(benchmark: DataFrame) -> tuple[int, Iterator[Index]]:
    """How many indexes a benchmark (item_id, text) takes, and the indexes, each made when it is asked for.

    Only what one index holds is fetched at a time; that is measured beforehand.
    """
    items = benchmark.select(F.col("item_id"), F.col("text").cast("string").alias("text"))
    characters, rows = items.agg(F.sum(F.length("text")), F.count("*")).first()
    full = max((characters or 0) / MOST_CHARACTERS, rows / max(1, MOST_CHARACTERS // 10))
    if full <= 1:
        return 1, iter([build(_fetched(items))])
    n = math.ceil(full) * 2
    return n, _parts(items, n)


def _fetched(items: DataFrame) -> list[tuple[int | None, str | None]]:
    return sorted(((r.item_id, r.text) for r in items.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def _parts(items: DataFrame, n: int) -> Iterator[Index]:
    # rows are dealt by their place, so that copies of one item spread; the written table fixes who is where
    dealt = stage(items.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n))), "benchmark")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [[w for p in split(t.as_py() or "") for part in _words(p) for w in part] for t in b.column(0)]
            words = [(p, w) for p, w in zip(b.column(1).to_pylist(), words) if len(w) >= SHINGLE]
            pairs = [list({f"{x} {y}" for x, y in zip(w, w[1:])}) for _, w in words]
            cols = [pa.array([p for p, _ in words], pa.int64()), pa.array([len(w) for _, w in words], pa.int64())]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(pairs, pa.list_(pa.string()))], ["part", "words", "pairs"])

    worded = stage(dealt.select("text", "part").mapInArrow(read, "part long, words long, pairs array<string>"), "benchmark-words")
    size, pairs, stride = worded.agg(F.count("*"), F.sum(F.col("words") - 1), F.max("words")).first()
    each = worded.select("part", F.explode("pairs").alias("pair")).groupBy("part", "pair").agg(F.count("*").alias("n"))
    each = stage(each, "benchmark-pairs")
    held = stage(each.groupBy("pair").agg(F.sum("n").alias("held")), "benchmark-held")
    for k in range(n):
        own = each.where(F.col("part") == k).join(held, "pair").select("pair", "held")
        counts = Counts(size, (pairs or 0) / max(size, 1), stride or 1, {r.pair: r.held for r in own.collect()})
        yield build(_fetched(dealt.where(F.col("part") == k).select("item_id", "text")), counts)


FOUND = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64())]
    + [("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("first_word", pa.int64())]
)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, score, overlaps, first_word of the window.

    NULL and empty texts hold nothing. A repeated document repeats its rows; NULL
    ids stay. Equal items are all listed. Of windows with the same score the first
    is told. An item of 1 to 4 words is held where they stand in a row, with score
    and overlaps of 1 and the first such place; items without a word aren't told.
    """
    n, parts = indexes(benchmark)
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = (_told(asked, index) for index in parts)
    return reduce(DataFrame.union, [stage(f, "contaminated") for f in found] if n > 1 else found)


def _told(docs: DataFrame, index: Index) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                for i, (score, question, answer, first) in sorted(matches(index, text.as_py()).items()):
                    rows.append(dict(zip(FOUND.names, (doc_id, index.item_ids[i], score, question, answer, first))))
            yield pa.RecordBatch.from_pylist(rows, FOUND)

    return docs.mapInArrow(run, from_arrow_schema(FOUND))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` whose text holds no item; all columns as they are, and no shuffle.

    What holds an item is told by `contaminated`; NULL and empty texts stay.
    """
    n, parts = indexes(benchmark)
    for index in parts:
        docs = _free(docs, index)
        docs = stage(docs, "decontaminated") if n > 1 else docs
    return docs


def _free(docs: DataFrame, index: Index) -> DataFrame:
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([not matches(index, t.as_py()) for t in b.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
