import math
import random
import zlib

import numpy as np

from thalweg.llm import toxicity

R = random.Random(6)
SYLLABLES = ["ma", "ru", "ti", "lo", "sen", "kab", "pe", "gor"]


def text(n, bad=0):
    words = ["".join(R.choice(SYLLABLES) for _ in range(R.randrange(1, 5))) for _ in range(n)]
    for _ in range(bad):
        words[R.randrange(n)] = R.choice(["vilescum", "Wretchus", "prevomitlo"])
    return " ".join(words)


def brute_segments(found, drift):
    """All maximal segments by the definition: repeatedly the best one of what is left."""
    if not found:
        return []
    n = found[-1][0] + 1
    x = np.full(n, -drift)
    for at, w in found:
        x[at] = w

    def best(lo, hi):
        top = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += x[j]
                if total > 1e-12 and (top is None or total > top[2] + 1e-9):
                    top = (i, j, total)
        if top is None:
            return []
        return best(lo, top[0]) + [top] + best(top[1] + 1, hi)

    return best(0, n)


def test_segments():
    for _ in range(150):
        n = R.randrange(1, 30)
        at = sorted(R.sample(range(n), R.randrange(0, n + 1)))
        found = [(i, R.randrange(1, 100) / 16 + R.random() / 1e3) for i in at]
        drift = R.choice([0.3, 1.1, 3.7])
        got = toxicity.segments(found, drift)
        want = brute_segments(found, drift)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_decay():
    lam = toxicity.decay(np.array([2.0, 3.0]), np.array([10.0, 5.0]), 10_000, 0.1)
    share = np.array([10.5, 5.5]) / 10_016
    assert abs((share * np.exp(lam * np.array([2.0, 3.0]))).sum() + 10_000 / 10_016 * math.exp(-0.1 * lam) - 1) < 1e-6


def test_logistic():
    a, b = toxicity.logistic([(0, 0, 900), (0, 1, 20), (10, 0, 5), (10, 1, 100)])
    assert b > 0 and 1 / (1 + math.exp(-a)) < 0.05 < 0.9 < 1 / (1 + math.exp(-(a + 10 * b)))


def test_detect(spark):
    docs, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        docs.append((i, text(R.randrange(20, 120), 4 if bad else 0), "x"))
        if i % 3 != 1:
            labels.append((i, 0, int(bad)))
    docs += [(None, "vilescum vilescum", None), (601, None, None), (602, "", ""), docs[0], (603, "word " * 300_000 + "vilescum " * 3, "")]
    labels += [(None, 1, 1), (5, None, None), (0, 1, 1), (9999, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    got = toxicity.detect(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs)
    by_id = {r.doc_id: r for r in got}
    wrong = [i for i in range(600) if by_id[i].predicted != (i % 6 == 0)]
    assert len(wrong) <= 6
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in got)
    assert by_id[601].score == by_id[602].score < 0.1 and by_id[None].score > 0.5
    assert len(by_id[0].passages) >= 1 and by_id[601].passages == []
    assert [p.last for p in by_id[603].passages] == [300_002]
    empty = toxicity.detect(d, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert {r.predicted for r in empty} == {0}
    assert toxicity.detect(d.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0
