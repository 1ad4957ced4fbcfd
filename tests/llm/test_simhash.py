import random

import pytest
import xxhash

from thalweg.llm import simhash
from thalweg.llm.components import components


def brute_fingerprint(text):
    words, word = [], ""
    for ch in (text or "") + " ":
        if ch in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += ch.lower() if "A" <= ch <= "Z" else ch
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_groups(rows):
    """rows of (doc_id, fp)"""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                root[find(b)] = find(a)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return sorted(((d, f, least.get(find(f))) for d, f in rows), key=str)


TEXTS = [
    None, "", " \t\n", "one", "One", "two words", "a b c", "a b c d", "a b c a b c", "É é Ü", "x y\u00a0z w",
    "word " * 2000, "Some longer text with many words that differ only at the very end of it all one",
]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bucket", [4096, 4])
def test_groups(spark, bucket, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    r = random.Random(7)
    rows, n = [], 0
    for size in (1, 2, 3, 12, 40):
        for _ in range(4):
            f = r.getrandbits(64)
            for _ in range(size):
                rows.append((n, f))
                n += 1
                for _ in range(r.randrange(5)):
                    f ^= 1 << r.randrange(64)
    rows += [(None, rows[3][1]), (None, r.getrandbits(64)), rows[0], (10**12, 0), (-5, 7)]
    df = spark.createDataFrame([(d, signed(f)) for d, f in rows], "doc_id long, fp long")
    got = sorted(((x.doc_id, x.fp % (1 << 64), x.component_id) for x in simhash.groups(df).collect()), key=str)
    assert got == brute_groups(rows)


def test_operator(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS * 2)] + [(None, "a b c", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((x.doc_id, x.fp % (1 << 64), x.component_id) for x in simhash.simhash_groups(df).collect()), key=str)
    assert got == brute_groups([(d, brute_fingerprint(t)) for d, t, _ in rows])
    assert simhash.simhash_groups(df.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(3)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(5, 5), (7, 3), (3, 7)]
    pairs += [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(220)] + [(None, 4), (9, None)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {x.node: x.label for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
