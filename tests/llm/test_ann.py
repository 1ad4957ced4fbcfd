import numpy as np
import pytest

from thalweg.llm import ann


def brute(ids, x, every, k):
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            s = (x * q).sum(axis=1)
            order = sorted((-v, j) for v, j in zip(s.tolist(), ids) if j != i)
            out[i] = [(j, -v) for v, j in order[:k]]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")


@pytest.mark.parametrize("sample", [16_384, 300])
def test_recall(spark, sample, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE", sample)
    monkeypatch.setattr(ann, "VECTORS", 64)
    monkeypatch.setattr(ann, "QUERIES", 16)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 48)).astype(np.float32) * rng.uniform(0.5, 2, (1500, 1)).astype(np.float32)
    x[700:1200] = x[3]  # a hot vector
    x[:, 40:] = 0
    rows = [(i, v, "c") for i, v in enumerate(x.tolist())]
    got: dict = {}
    for r in ann.search(frame(spark, rows), 20, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(range(1500), x.astype(float), 20, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hit = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hit) >= 0.9
    exact = {(i, j): float((x[i].astype(float) * x[j].astype(float)).sum()) for i in got for j, _ in got[i]}
    assert all(abs(exact[q, j] - s) < 1e-9 for q in got for j, s in got[q])
    assert all(v == sorted(v, key=lambda p: (-p[1], p[0])) for v in got.values())


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], ""), (1, [1.0, 0.0], ""), (2, [-1.0, 0.0], ""), (3, None, ""), (4, [0.0, 0.0], ""), (5, [nan, 1.0], ""), (6, [inf, 1.0], "")]
    rows += [(7, [None, 1.0], ""), (None, [1.0, 1.0], ""), (8, [1.0], ""), (9, [], ""), (20, [0.5, 0.5], None), (0, [1.0, 0.0], "")]
    got = [tuple(r) for r in ann.search(frame(spark, rows), 20, 20).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 20, 0.5), (0, 3, 2, -1.0), (20, 1, 0, 0.5), (20, 2, 1, 0.5), (20, 3, 2, -0.5)]
    assert ann.search(frame(spark, []), 20, 20).count() == 0
    assert ann.search(frame(spark, rows[:1]), 20, 20).count() == 0


def test_scan_abandons_far_pairs_only():
    rng = np.random.default_rng(2)
    x, q = rng.standard_normal((2000, 64)).astype(np.float32), rng.standard_normal((20, 64)).astype(np.float32)
    d = ((q[:, None] - x) ** 2).sum(axis=2)
    limit = np.sort(d, axis=1)[:, 19]
    i, j = ann.scan(x, q, limit)
    near = d <= limit[:, None]
    found = np.zeros_like(near)
    found[i, j] = True
    assert found[near].mean() > 0.97 and len(i) <= near.sum() * 1.01


@pytest.mark.parametrize("power", [-160, 0, 150, 1000])
def test_any_magnitude(spark, power):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 16)) * 2.0**power if power > 0 else rng.standard_normal((400, 16)) * 10.0**power
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in ann.search(df, 20, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    unit = x / 2.0**power if power > 0 else x / 10.0**power
    want = brute(range(400), unit, 20, 5)
    assert got.keys() == want.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9
    if power == 0:
        assert all(abs(s - (x[q] * x[i]).sum()) < 1e-12 for q in got for i, s in got[q])
    elif power == 1000:
        assert all(s == np.inf for q in got for _, s in got[q])
