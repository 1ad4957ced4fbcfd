"""Toxic passages: maximum-scoring segments over token log-odds.

Tokens are the 5- and 7-letter pieces of words, with a gap on either side of the
word, so that insults inside longer words are seen as well. Labelled documents give
each token's log-odds between toxic and other text under an informative Dirichlet
prior (its share of all their tokens). A word weighs as much as its heaviest
significantly toxic token, any other word slightly less than nothing; a linear scan
finds all maximal segments of a text. Segment scores of random text have an
extreme-value tail, so a text's best segment gets the score lambda S - ln(K n):
lambda solves the usual equation over the weights in clean text, K is fitted to the
segments in clean text. A logistic curve over that score gives the probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.langid import _is_letter, _slices, held_out
from thalweg.staging import stage

#: About so many labelled rows are fitted on, chosen by a hash of the id, if there are more.
FIT_ROWS = 60_000
#: Prior weight as a share of all tokens (besides half an occurrence each), and least z-score and log-odds of a toxic token.
PRIOR, SIGNIFICANT, LEAST = 0.001, 3.5, 1.0
#: A passage is significant if fewer than this many as good are expected in random text of the document's length.
EXPECTED = 0.05
#: Bounds of the extreme-value score, and bins of its calibration; below 0 more than one as good is expected by chance.
LOW, HIGH, BIN = 0.0, 60.0, 0.25
SIZES = (5, 7)
#: Slots of the quick test before a token's weight is looked up.
SLOTS = 1 << 22

_FACTORS = np.random.default_rng(6).integers(1 << 62, size=max(SIZES) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Model:
    tokens: np.ndarray  # sorted hashes
    weights: np.ndarray
    drift: float
    lam: float
    k: float
    intercept: float
    slope: float

    def extreme(self, best: float, n: int) -> float:
        """The extreme-value score of a best segment among n words; `LOW` without a segment."""
        return min(HIGH, max(LOW, self.lam * best - math.log(self.k * max(n, 1)))) if best > 0 else LOW

    def probability(self, x: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.intercept + self.slope * x))))


def tokens(parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size the tokens' hashes and first positions among all characters of the parts, each after a gap."""
    codes = np.frombuffer(("\n" + "\n".join(parts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[codes]
    c = np.where(letter, codes, 0).astype(np.uint64)
    for n in SIZES:
        m = len(c) - n + 1
        if m < 1:
            continue
        inside = letter[1 : m + 1].copy()
        for k in range(2, n - 1):
            inside &= letter[k : m + k]
        at = np.flatnonzero(inside)
        h = np.full(len(at), n, np.uint64) * _FACTORS[-1]
        for k in range(n):
            h = (h + c[at + k]) * _FACTORS[k]
        yield h ^ (h >> np.uint64(32)), at


def _words(parts: list[str]) -> np.ndarray:
    """How many words have begun up to each character, counted over all parts; and 0 before."""
    codes = np.frombuffer(("\n" + "\n".join(parts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[codes]
    return np.cumsum(letter & ~np.concatenate([[False], letter[:-1]]))


def _quick(found: np.ndarray) -> np.ndarray:
    slots = np.zeros(SLOTS, bool)
    slots[found & np.uint64(SLOTS - 1)] = True
    return slots


def hits(texts: list[str | None], known: np.ndarray, weights: np.ndarray, quick: np.ndarray) -> tuple[list[list[tuple[int, float]]], list[int]]:
    """For each text (word, weight) of its toxic words in order, and how many words it has."""
    found, n = [[] for _ in texts], [0] * len(texts)
    for at, parts in _slices(texts):
        words = _words(parts)
        ends = np.cumsum([len(p) + 1 for p in parts])
        before = words[np.concatenate([[0], ends[:-1]])]
        best: dict[tuple[int, int], float] = {}
        for h, pos in tokens(parts):
            maybe = np.flatnonzero(quick[h & np.uint64(SLOTS - 1)])
            i = np.minimum(np.searchsorted(known, h[maybe]), max(len(known) - 1, 0))
            sure = known[i] == h[maybe] if len(known) else np.zeros(0, bool)
            first = pos[maybe[sure]] + 1
            for part, word, w in zip(np.searchsorted(ends, first, "right").tolist(), words[first].tolist(), weights[i[sure]].tolist()):
                best[part, word] = max(w, best.get((part, word), w))
        for (part, word), w in sorted(best.items()):
            found[at[part]].append((n[at[part]] + word - int(before[part]) - 1, w))
        for part, total in enumerate((words[ends] - before).tolist()):
            n[at[part]] += total
    return found, n


def segments(found: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of positive words in a sea of -drift ones, in linear time."""
    stack: list[list] = []  # first, last, total before, total after, index of the last earlier one with less before
    total, last = 0.0, -1
    for at, weight in found:
        total -= drift * (at - last - 1)
        new = [at, at, total, total + weight, None]
        total, last = total + weight, at
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= new[3]:
                new[4] = j
                stack.append(new)
                break
            new[0], new[2] = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s[0], s[1], s[3] - s[2]) for s in stack]


def fitting_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic of the labelled rows that are learned from: not held out, one per different text."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", 5, 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, FIT_ROWS / max(1, known.count()))
    known = F.broadcast(known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))))
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).join(known, "doc_id")
    return texts.groupBy("h").agg(F.min(F.struct("doc_id", "toxic")).alias("r")).select("r.doc_id", "r.toxic")


def token_counts(rows: DataFrame) -> DataFrame:
    """token, bad and good (occurrences), bad_docs and good_docs over `rows` (toxic, text)."""
    names = ["token", "bad", "good", "bad_docs", "good_docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for b in batches:
            toxic = np.array([x > 0 for x in b.column(0).to_pylist()], bool)
            for at, parts in _slices(b.column(1).to_pylist()):
                ends = np.cumsum([len(p) + 1 for p in parts])
                for h, pos in tokens(parts):
                    if len(h):
                        doc = np.array(at)[np.searchsorted(ends, pos + 1, "right")]
                        kept.append(_summed(h, doc, toxic))
                        size += len(kept[-1][0])
            if size > 1 << 21:
                kept = [_merged(kept)]
                yield _counted(kept[0], names)
                kept, size = [], 0
        if kept:
            yield _counted(_merged(kept), names)

    each = rows.select("toxic", "text").mapInArrow(run, ", ".join(f"{c} long" for c in names))
    return each.groupBy("token").agg(*[F.sum(c).alias(c) for c in names[1:]])


def _summed(h: np.ndarray, doc: np.ndarray, toxic: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(h, kind="stable")  # documents stay in order within a token
    h, doc = h[order], doc[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(new)
    n, bad = np.diff(np.append(first, len(h))), toxic[doc[first]]
    h = h[first]
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return [h[starts], *(np.add.reduceat(x.astype(np.int64), starts) for x in (n * bad, n * ~bad, bad, ~bad))]


def _merged(kept: list[list[np.ndarray]]) -> list[np.ndarray]:
    h, *counts = (np.concatenate(x) for x in zip(*kept))
    order = np.argsort(h)
    h = h[order]
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return [h[starts], *(np.add.reduceat(x[order], starts) for x in counts)]


def _counted(cols: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[0].view(np.int64)), *map(pa.array, cols[1:])], names)


def log_odds(counts: DataFrame, bad_rows: int, good_rows: int) -> list[tuple[int, float]]:
    """Token and log-odds of the significantly toxic ones: in the documents that have them, and in their occurrences.

    Only these reach the driver; each needs several of the fitted documents, which are bounded.
    """
    all_bad, all_good = counts.agg(F.sum("bad"), F.sum("good")).first()
    if not all_bad or not all_good:
        return []

    def odds(bad: str, good: str, n_bad: float, n_good: float) -> tuple:
        strength = PRIOR * (n_bad + n_good)
        alpha = strength * (F.col(bad) + F.col(good)) / (n_bad + n_good) + 0.5
        x, y = F.col(bad) + alpha, F.col(good) + alpha
        return F.log(x / n_bad) - F.log(y / n_good), F.sqrt(1 / x + 1 / y)

    delta, _ = odds("bad", "good", all_bad, all_good)
    by_doc, spread = odds("bad_docs", "good_docs", bad_rows, good_rows)
    rows = counts.select("token", delta.alias("delta"), (by_doc / spread).alias("z")).where((F.col("z") >= SIGNIFICANT) & (F.col("delta") >= LEAST))
    return [(r.token, r.delta) for r in rows.select("token", "delta").collect()]


def decay(weights: np.ndarray, counts: np.ndarray, others: int, drift: float) -> float:
    """lambda: the positive root of the mean of exp(lambda * weight) over clean words being 1; `others` weigh -drift."""
    total = counts.sum() + others + 1.0
    share, rest = (counts + 1.0 / len(counts)) / total, max(others, 1) / total

    def over(lam: float) -> float:
        return float((share * np.exp(np.minimum(lam * weights, 700))).sum() + rest * math.exp(-lam * drift) - 1)

    low, high = 0.0, 1e-3
    while over(high) <= 0 and high < 1e3:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if over(mid) <= 0 else (low, mid)
    return high


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from `labels` (doc_id, toxic) that aren't held out, and the texts of `docs` (doc_id, text) they belong to."""
    chosen = stage(fitting_rows(docs, labels), "toxicity-rows")
    size = dict(chosen.groupBy((F.col("toxic") > 0).alias("bad")).count().collect())
    rows = docs.join(F.broadcast(chosen), "doc_id").select("toxic", "text")
    odds = log_odds(stage(token_counts(rows), "toxicity-tokens"), size.get(True, 0), size.get(False, 0)) if len(size) == 2 else []
    if not odds:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 1.0, 1.0, 1.0, -5.0, 0.0)
    odds.sort(key=lambda x: x[0] % (1 << 64))
    known, weights = np.array([t for t, _ in odds], np.int64).view(np.uint64), np.array([d for _, d in odds])

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quick = _quick(known)
        for b in batches:
            found, n = hits(b.column(1).to_pylist(), known, weights, quick)
            cols = [b.column(0), pa.array(n, pa.int64()), *(pa.array([[x[i] for x in f] for f in found], pa.list_(t)) for i, t in enumerate((pa.int64(), pa.float64())))]
            yield pa.RecordBatch.from_arrays(cols, ["toxic", "n", "words", "weights"])

    seen = stage(rows.mapInArrow(weighed, "toxic int, n long, words array<long>, weights array<double>"), "toxicity-words")
    n_words = {r.bad: (r.n, r.hits) for r in seen.groupBy((F.col("toxic") > 0).alias("bad")).agg(F.sum("n").alias("n"), F.sum(F.size("weights")).alias("hits")).collect()}
    (n_bad, h_bad), (n_good, h_good) = n_words.get(True, (0, 0)), n_words.get(False, (0, 0))
    # what a word without a toxic token says, by the same log-odds
    drift = max(1e-3, -math.log((1 - h_bad / max(n_bad, 1) + 1e-9) / (1 - h_good / max(n_good, 1) + 1e-9)))
    spread = seen.where("toxic = 0").select(F.explode("weights").alias("w")).groupBy(F.round("w", 1).alias("w")).count().collect() or [(LEAST, 0)]
    lam = decay(np.array([r[0] for r in spread]), np.array([r[1] for r in spread], float), n_good - h_good, drift)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [[s for _, _, s in segments(list(zip(w, x)), drift)] for w, x in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            cols = [b.column(0), b.column(1), pa.array([max(s, default=0.0) for s in scores], pa.float64()), pa.array([sum(x >= LEAST for x in s) for s in scores], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["toxic", "n", "best", "found"])

    scored = seen.mapInArrow(best, "toxic int, n long, best double, found long")
    got = scored.where("toxic = 0").agg(F.sum("found"), F.sum("n")).first()
    k = min(1.0, ((got[0] or 0) + 1) / (max(got[1] or 0, 1) * math.exp(-lam * LEAST)))
    x = F.when(F.col("best") > 0, F.greatest(F.lit(LOW), F.least(F.lit(HIGH), lam * F.col("best") - F.log(k * F.greatest("n", F.lit(1)))))).otherwise(LOW)
    bins = scored.groupBy(F.round(x / BIN).cast("int").alias("bin"), (F.col("toxic") > 0).alias("bad")).agg(F.count("*").alias("n")).collect()
    return Model(known, weights, drift, lam, k, *logistic([(r.bin * BIN, int(r.bad), r.n) for r in bins]))


def logistic(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope (not negative) of a logistic curve through (x, class, count), with smoothed targets."""
    x = np.array([b[0] for b in bins], float)
    y = np.array([b[1] for b in bins], float)
    n = np.array([b[2] for b in bins], float)
    bad, good = (n * y).sum(), (n * (1 - y)).sum()
    target = np.where(y > 0, (bad + 1) / (bad + 2), 1 / (good + 2))
    beta = np.array([math.log((bad + 1) / (good + 1)), 0.0])
    design = np.stack([np.ones_like(x), x], axis=1)

    def loss(b: np.ndarray) -> float:
        z = design @ b
        return float((n * (np.logaddexp(0, z) - target * z)).sum() + 1e-3 * b[1] ** 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        slope = design.T @ (n * (p - target)) + [0, 2e-3 * beta[1]]
        curve = (design * (n * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ design + np.diag([1e-9, 2e-3])
        step, size = np.linalg.solve(curve, slope), 1.0
        while loss(beta - size * step) > loss(beta) and size > 1e-6:
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(beta[0]), float(max(0.0, beta[1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and passages for every row: significant segments as (first word, last word, expected number as good).

    NULL and empty texts have no passage and the score of such texts. Repeated rows
    and NULL ids stay; other columns aren't read.
    """
    fields = [("first", pa.int64()), ("last", pa.int64()), ("expected", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quick = _quick(model.tokens)
        for b in batches:
            scores, passages = [], []
            for found, n in zip(*hits(b.column(1).to_pylist(), model.tokens, model.weights, quick)):
                every = segments(found, model.drift)
                scores.append(model.probability(model.extreme(max((s for _, _, s in every), default=0.0), n)))
                expected = [(i, j, model.k * n * math.exp(-model.lam * s)) for i, j, s in every]
                passages.append([dict(zip(("first", "last", "expected"), e)) for e in expected if e[2] <= EXPECTED])
            cols = [b.column(0), pa.array(scores, pa.float64()), pa.array(passages, pa.list_(pa.struct(fields)))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "score", "passages"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, "doc_id long, score double, passages array<struct<first:long,last:long,expected:double>>")


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from 0.5 on) and passages of every row of `docs`."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    found = score(docs, fit(docs, labels))
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")
