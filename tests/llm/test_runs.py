import hashlib
import random
import zlib

import numpy as np
import pytest

from thalweg.llm import runs


def brute(w):
    """All runs of a list of words, by trying every stretch of every period."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - s
            if n >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(s, s + n - p)) for p in range(1, q)):
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    for c in "\t\n\v\f\r":
        text = (text or "").replace(c, " ")
    w = [x for x in (text or "").split(" ") if x]
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[:1]
    first = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    return doc_id, len(found), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


def planted(r, words, n):
    w = [r.choice(words) for _ in range(n)]
    for _ in range(r.randrange(4)):
        block = [r.choice(words) for _ in range(r.randrange(1, 9))]
        at = r.randrange(len(w) + 1)
        w[at:at] = (block * r.randrange(3, 9))[: r.randrange(1, 60)]
    return w


@pytest.mark.parametrize("vocabulary", [1, 2, 3, 5, 40])
def test_runs(vocabulary):
    r = random.Random(vocabulary)
    for _ in range(300):
        w = planted(r, range(vocabulary), r.randrange(90))
        assert runs.find_runs(np.array(w, np.int32)) == brute(w)


def test_segments_hold_every_run():
    w = [9, 1, 2, 1, 2, 1, 2, 1, 2, 8, 1, 2, 7, 3, 3, 3, 3, 3, 3, 6, 1, 4]
    assert runs.segments(np.array(w, np.int32)) == [(1, 9), (13, 19)]
    assert runs.segments(np.arange(100, dtype=np.int32)) == []


@pytest.mark.parametrize("step", [1 << 22, 16])
def test_operator(spark, step, monkeypatch):
    monkeypatch.setattr(runs, "STEP", step)
    r = random.Random(3)
    texts = [None, "", " \t\n\x0b", "one", "a a a a a a", "a a " * 6, "É é " * 5, "x\x1cy " * 7, "lorem ipsum dolor " * 500]
    texts += [" ".join(planted(r, "ab cd ef gh ij the of".split(), r.randrange(80))) for _ in range(60)]
    rows = [(i, t, "x") for i, t in enumerate(texts * 2)] + [(None, "a b " * 8, None), (7, "a b " * 8, None), (7, "a b " * 8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string")
    mine = [tuple(x)[:8] for x in runs.periodic(docs, change=True).collect()]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, *_ in rows) > 5
    if step > 16:
        assert sorted(mine, key=str) == sorted((brute_row(d, t) for d, t, _ in rows), key=str)
    else:  # the workers read the module anew, so the step is tried here
        assert [runs.judge(d, t)[:8] for d, t, _ in rows] == [brute_row(d, t) for d, t, _ in rows]
    assert runs.periodic(docs.limit(0)).count() == 0


def test_long_text():
    text = "w " * 300_000
    row = runs.judge(None, text)
    assert row[1:6] == (1, 0, 300_000, 1, 300_000_000)
    assert row[7] == hashlib.sha256(b"w").hexdigest()
