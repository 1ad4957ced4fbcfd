import hashlib
import random

import numpy as np
import pytest

from thalweg.llm import substrings

R = random.Random(12)


def prose(n, letters="abcde "):
    return "".join(R.choice(letters) for _ in range(n))


def brute(rows):
    """(doc_id, text) to the result; repeated rows are one document."""
    order = sorted({(d is None, d or 0, t or "") for d, t in rows})
    seen, out = set(), {}
    for none, d, t in order:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - 99):
            window = raw[s : s + 100]
            if window in seen:
                gone[s : s + 100] = True
            seen.add(window)
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone]) if raw else b""
        n_spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if raw else 0
        out[None if none else d, t] = (len(raw), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest())
    return sorted(((d, *out[d, t or ""]) for d, t in rows), key=str)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, pos string")
    return sorted((tuple(r) for r in substrings.remove_repeats(df).collect()), key=str)


def test_anchors():
    data = np.frombuffer(prose(5000).encode(), np.uint8)
    pos, h = substrings.anchors(data)
    for s in range(0, len(data) - 99):  # every string holds an anchor
        assert np.searchsorted(pos, s) < np.searchsorted(pos, s + 69)
    again, g = substrings.anchors(np.concatenate([data[1000:1400], data]))
    inside = {int(p) + 1000: int(x) for p, x in zip(again, g) if 68 <= p < 400 - 100}
    assert inside.items() <= {int(p): int(x) for p, x in zip(pos, h)}.items() and inside


def test_anchors_in_steps(monkeypatch):
    data = np.frombuffer(prose(3000).encode(), np.uint8)
    whole = substrings.anchors(data)
    monkeypatch.setattr(substrings, "STEP", 256)
    assert all((a == b).all() for a, b in zip(whole, substrings.anchors(data)))


@pytest.mark.parametrize("rows_at_a_time, large", [(1 << 14, 1 << 17), (1, 1 << 17), (8, 3)])
def test_equals_brute_force(spark, rows_at_a_time, large, monkeypatch):
    monkeypatch.setattr(substrings, "ROWS", rows_at_a_time)
    monkeypatch.setattr(substrings, "LARGE", large)
    passages = [prose(n) for n in (99, 100, 101, 250, 700)] + [prose(300, "äöü€🙂ab")]
    rows = []
    for i in range(60):
        parts = [prose(R.randrange(0, 300))]
        for _ in range(R.randrange(0, 4)):
            p = R.choice(passages)
            a = R.randrange(0, 60)
            parts += [p[a:] if R.random() < 0.5 else p, prose(R.randrange(0, 150))]
        rows.append((i, "".join(parts)))
    base = rows[7][1] + prose(500)
    for i in range(12):  # near copies
        t = list(base)
        for _ in range(i % 4):
            t[R.randrange(len(t))] = "Z"
        rows.append((100 + i, "".join(t)))
    rows += [(200, "a" * 350), (201, "ab" * 260), (202, "a" * 120), (203, None), (204, ""), (205, prose(99)), (None, rows[3][1]), (206, passages[3] * 4)]
    rows += [rows[0], rows[70]]
    assert got(spark, rows) == brute(rows)


def test_edges(spark):
    same = prose(400)
    assert got(spark, [(1, same), (1, same)]) == brute([(1, same), (1, same)])
    assert got(spark, [(None, same), (5, same), (-5, same)]) == brute([(None, same), (5, same), (-5, same)])
    assert substrings.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    two = got(spark, [(1, same), (1, same + "!")])  # one id, two texts: one of them keeps the string
    assert sorted(r[2] for r in two) == [0, 400]
