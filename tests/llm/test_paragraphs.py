import glob
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from thalweg.llm import paragraphs

R = random.Random(8)


def line(n=40):
    return " ".join("".join(R.choice("abcdefghij") for _ in range(R.randrange(2, 7))) + ("." if i % 9 == 8 else "") for i in range(n))


def edited(text, word):
    w = text.split()
    w[word] = "edited"
    return " ".join(w)


def test_tuned():
    bands, rows = paragraphs.tuned(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 64
    assert 1 - (1 - 0.3**rows) ** bands < 0.2


def banded(many):
    return paragraphs.bands(*paragraphs._shingles(many))


def test_bands_tell_similarity():
    words = [[f"w{R.randrange(10**9)}" for _ in range(n)] for n in (5, 6, 20, 300)]
    again = banded(words)
    assert (again == banded(words)).all() and (again[1] == banded([words[1]])[0]).all()
    hit = 0
    for _ in range(200):
        a = [f"w{R.randrange(10**9)}" for _ in range(100)]
        b = a[:-12] + [f"w{R.randrange(10**9)}" for _ in range(12)]
        assert paragraphs.jaccard(a, b) > 0.75
        x, y = banded([a, b])
        hit += bool((x == y).any())
    assert hit >= 196


@pytest.mark.parametrize("small", [32, 2])
def test_near_equal_lines_are_clustered(spark, small, monkeypatch):
    monkeypatch.setattr(paragraphs, "SMALL", small)
    base = [line(120) for _ in range(12)]
    docs, want = [], {}
    for i in range(60):  # five variants of each line, among own text
        k = i % 12
        docs.append((i, f"{line(60)}\n{edited(base[k], 3 + 9 * (i // 12)) if i >= 12 else base[k]}\n{line(10)}"))
        want.setdefault(k, []).append(i)
    docs += [(100 + i, line(200)) for i in range(10)]
    got = {r.doc_id: r for r in paragraphs.repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert set(got) == set(range(60))
    for k, ids in want.items():
        assert {got[i].class_id for i in ids} == {k}
        assert got[k].n_removed == 0 and all(got[i].n_removed == 1 for i in ids[1:])


def test_passage_inside_a_line(spark):
    passage = line(90)
    docs = [(1, f"{line(50)}. {passage} {line(50)}"), (2, f"{line(30)}.\n{line(33)}. {passage} {line(40)}"), (3, line(150))]
    got = {r.doc_id: r for r in paragraphs.repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert set(got) == {1, 2} and got[2].removed_chars > 100 and got[1].n_removed == 0


def test_edges(spark):
    same = line(50)
    docs = [(1, same, "x"), (1, same, "x"), (2, None, "x"), (3, "", None), (4, line(19), "x"), (5, line(19), "x"), (None, same, "x"), (6, f"{same}\n{same}", "y")]
    got = {r.doc_id: r for r in paragraphs.repeats(spark.createDataFrame(docs, "doc_id long, text string, line string")).collect()}
    assert set(got) == {1, 6, None}
    assert got[1].n_removed == 0 and got[6].n_removed == 2 and got[None].n_removed == 1
    assert got[None].kept_in == [1] and got[6].kept_in == [1] and got[6].removed_chars == 2 * len(same)
    assert paragraphs.repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_row_alone_is_no_repeat(spark):
    same = line(50)
    df = spark.createDataFrame([(1, same), (1, same)], "doc_id long, text string")
    assert paragraphs.repeats(df).count() == 0


def test_pairs_of_buckets():
    rows = np.array([[0] * 32 + [1] * 3 + [2], [*range(32), 1, 2, 40, 7]], np.int64)
    pairs = [(a, b) for batch in paragraphs._pairs(rows) for a, b in zip(*(c.to_pylist() for c in batch.columns))]
    assert len(pairs) == 32 * 31 // 2 + 3
    assert set(pairs) == {(a, b) for b in range(32) for a in range(b)} | {(1, 2), (1, 40), (2, 40)}


def clustered(clusters, variants):
    """Word lists from one template: below the threshold across clusters, near it within."""
    base = line(60).replace(".", "").split()
    out = []
    for c in range(clusters):
        own = list(base)
        for k in (7, 41):
            own[k] = f"cluster{c}x{k}"
        for v in range(variants):
            w = list(own)
            w[(5 * v) % 60] = f"variant{c}y{v}"
            out.append(w)
    R.shuffle(out)
    return out


def brute_components(many):
    label = list(range(len(many)))
    for i in range(len(many)):
        for j in range(i):
            if label[i] != label[j] and paragraphs.jaccard(many[i], many[j]) >= paragraphs.SIMILARITY:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_large_bucket_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(paragraphs, "BLOCK", 90)  # several blocks
    many = clustered(100, 3)
    want = brute_components(many)
    assert 20 < len(set(want)) < len(many)
    # one bucket that holds all of them, so each link can come from nowhere else
    scanned = spark.createDataFrame([(k, 0, " ".join(w), [1]) for k, w in enumerate(many)], "uid long, level int, line string, bands array<long>")
    pairs, members = paragraphs.candidates(scanned)
    label = {u: u for u in (r.uid for r in scanned.collect())}
    for a, b in paragraphs.verified(pairs, scanned).union(paragraphs.linked(members, scanned)).collect():
        old, new = label[a], label[b]
        label = {u: new if x == old else x for u, x in label.items()}
    got = [label[u] for u in (r.uid for r in scanned.collect())]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def plain(n):
    return line(n).replace(".", "").split()


def wrapped(words, n):
    return "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))


def runs(text):
    """(start, end, id) of a text's runs."""
    _, _, s, e, ids, _ = paragraphs.units([text])[2]
    return list(zip(s.tolist(), e.tolist(), ids.tolist()))


def test_runs_do_not_depend_on_surroundings():
    for _ in range(50):
        shared = plain(paragraphs.ANCHOR + paragraphs.RUN - 1)
        a, b = (wrapped(plain(R.randrange(40)) + shared + plain(R.randrange(40)), n) for n in (9, 1000))
        x, y = ({i for _, _, i in runs(t)} for t in (a, b))
        assert x & y
    again = runs("again " * 5000)
    assert 1 < len(again) <= 5000 // paragraphs.RUN + 1 and all(a[1] < b[0] for a, b in zip(again, again[1:]))


WORD = re.compile(r"[^\W_]+")


def brute_paragraphs(text):
    out, short, at = [], [], 0
    for part in [*text.split("\n"), ""]:
        n = len(WORD.findall(part))
        if 0 < n < paragraphs.LINE_WORDS:
            short.append((at, at + len(part), n))
        else:
            if sum(x[2] for x in short) >= paragraphs.LINE_WORDS:
                out.append((short[0][0], short[-1][1]))
            short = []
            if n:
                out.append((at, at + len(part)))
        at += len(part) + 1
    return out


def brute_sentences(text, s, e):
    return [(m.start(), m.end()) for m in re.compile(r"(?<=[.?!])\s+").finditer(text, s, e)]


def odd_texts():
    parts = ["word", "Ünï", "İx", "a_b", "дом", "१२", "x.y", "end.", "so?", "!", "—", "\U00010400", "ß", "\u3000"]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", " \n ", "\t", "\r\n", "\x85", "\u2028"]
    out = ["", " ", "\n", "\n\n", "one", "no stop", "a. " * 60, "." * 50]
    for n in (3, 30, 90, 300, 1500):
        for _ in range(6):
            wide = R.random() < 0.5
            out.append("".join(R.choice(parts) + (" " if wide and R.random() < 0.95 else R.choice(gaps)) for _ in range(n)))
    return out


def test_units_equal_brute_force():
    texts = odd_texts()
    got = paragraphs.units(texts)
    by = [[[] for _ in texts] for _ in range(3)]
    for level, text, s, e, ids, _ in got:
        for t, a, b, i in zip(text.tolist(), s.tolist(), e.tolist(), ids.tolist()):
            by[level][t].append((a, b, i))
    names = {}
    for level in range(3):
        for t, found in enumerate(by[level]):
            for a, b, i in found:  # equal ids mean equal words, and the other way round
                words = tuple(WORD.findall("".join(c.lower() if len(c.lower()) == 1 else c for c in texts[t][a:b])))
                assert names.setdefault((level, words), i) == i
    assert len(set(names.values())) == len(names) > 500
    several = 0
    for t, text in enumerate(texts):
        whole = brute_paragraphs(text)
        assert [x[:2] for x in by[0][t]] == whole
        pieces = {x[:2] for x in by[1][t]}
        assert len(pieces) == len(by[1][t])
        ends = {p: brute_sentences(text, *p) for p in whole}
        for a, b in pieces:
            (s, e), = [p for p in whole if p[0] <= a and b <= p[1]]
            assert (a, b) != (s, e) and len(WORD.findall(text[a:b])) >= paragraphs.PIECE_WORDS
            assert a in [s, *(y for _, y in ends[s, e])] and b in [e, *(x for x, _ in ends[s, e])]
            several += 1
        words = [m.span() for m in WORD.finditer(text)]
        starts = [k for k, (a, _) in enumerate(words) if a in {x[0] for x in by[2][t]}]
        assert [(words[k][0], words[k + paragraphs.RUN - 1][1]) for k in starts] == [x[:2] for x in by[2][t]]
        if len({text[a:b] for a, b in words}) == len(words) >= 50:
            assert all(any(k <= x < k + paragraphs.ANCHOR for x in starts) for k in range(len(words) - 49))
    assert several > 30
    # a text's units don't depend on the texts read with it
    for t, text in enumerate(texts):
        assert [list(zip(s.tolist(), e.tolist(), i.tolist())) for _, _, s, e, i, _ in paragraphs.units([text])] == [by[level][t] for level in range(3)]


@pytest.mark.parametrize("step", [1 << 20, 300])
def test_whole_query_equals_brute_force(spark, step, monkeypatch):
    monkeypatch.setattr(paragraphs, "STEP", step)
    pool = [line(n) for n in (25, 40, 60, 90, 90, 150)]
    docs = []
    for d in range(40):
        parts = [line(R.choice([5, 15, 30, 70])) for _ in range(R.randrange(4))]
        for p in R.sample(pool, 2):
            kind = R.randrange(4)
            parts.append([p, edited(p, R.randrange(len(p.split()))) if len(p.split()) > 80 else p, f"{line(12)} {p} {line(12)}", wrapped(p.split(), 11)][kind])
        R.shuffle(parts)
        docs.append((d if d % 13 else None, "\n".join(parts)))
    docs += [docs[3], docs[3], (None, None), (7, ""), (50, line(200))]
    places = []
    for key, text in set(docs):
        for level, _, s, e, _, _ in paragraphs.units([text or ""]):
            for a, b in zip(s.tolist(), e.tolist()):
                words = WORD.findall(text[a:b].lower())
                places.append(((key is None, key or 0, text), a, b, level, tuple(words)))
    groups = {(p[3], p[4]): k for k, p in enumerate(places)}
    label = {k: k for k in groups.values()}
    whole = [(w, k) for (level, w), k in groups.items() if level == 0]
    for i, (x, k) in enumerate(whole):
        for y, m in whole[:i]:
            if label[k] != label[m] and paragraphs.jaccard(list(x), list(y)) >= paragraphs.SIMILARITY:
                old, new = label[k], label[m]
                label = {a: new if b == old else b for a, b in label.items()}
    classes = {}
    for key, a, b, level, words in places:
        classes.setdefault(label[groups[level, words]], set()).add((key, a, b))
    want = {}
    hashed = {(r.doc_id, r.text): r.h for r in spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "hash(coalesce(text, '')) AS h").collect()}
    for members in classes.values():
        order = sorted(members, key=lambda m: (m[0][0], m[0][1], hashed[None if m[0][0] else m[0][1], m[0][2]], m[1]))
        if len({(m[0], m[1]) for m in members}) > 1:
            for key, a, b in order:
                held, gone = want.setdefault(key, (set(), set()))
                held.add((a, b))
                if (key, a) != (order[0][0], order[0][1]):
                    gone.add((a, b))
    got = paragraphs.repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(got) == len(want)
    for (none, key, _), (held, gone) in want.items():
        merged = []
        for a, b in sorted(gone):
            if merged and merged[-1][1] >= a:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        row = (None if none else key, len(held), ",".join(f"{a}:{b}" for a, b in merged))
        assert row in [(r.doc_id, r.n_repeated, r.removed) for r in got]


def test_wrapped_text_and_long_sentences(spark):
    rows, want = [], set()
    for i in range(20):
        passage = plain(60)
        if i % 2:  # one sentence amid others
            rows += [(2 * i + k, " ".join(plain(37 + k) + passage + plain(50))) for k in (0, 1)]
        else:  # over line ends, which fall elsewhere, next to own short lines
            rows += [(2 * i + k, wrapped(plain(31) + passage + plain(25), 12 + k)) for k in (0, 1)]
        want |= {2 * i, 2 * i + 1}
    near = plain(100)
    rows += [(100, f"{wrapped(plain(30), 10)}\n\n{wrapped(near, 12)}\n\n{wrapped(plain(30), 10)}"), (101, f"{wrapped(plain(30), 10)}\n\n{wrapped([w if i % 40 != 25 else 'edited' for i, w in enumerate(near)], 15)}")]
    rows += [(200 + i, wrapped(plain(90), 13)) for i in range(10)]
    got = {r.doc_id: r for r in paragraphs.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == want | {100, 101}
    assert all(got[2 * i + 1].class_id == 2 * i and got[2 * i + 1].removed_chars > 100 for i in range(20))
    assert got[101].class_id == 100 and got[101].removed_chars > 400


def test_shuffles_do_not_pile_up(spark):
    def files():
        folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}

    rows = [(i, f"{line(40)}\n{line(60)}") for i in range(20)]
    rows += [(100 + i, rows[i][1] if i % 2 else edited(rows[i][1], 50)) for i in range(10)]
    before, was = files(), spark.conf.get(paragraphs.FREE_SHUFFLES)
    found = paragraphs.repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    for _ in range(50):  # they go a moment after their job
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and spark.conf.get(paragraphs.FREE_SHUFFLES) == was
    assert {r.doc_id for r in found.collect()} == {*range(10), *range(100, 110)}


def test_texts_move_once_for_pairs_and_large_buckets(spark, monkeypatch):
    made = []
    stage = paragraphs.stage
    monkeypatch.setattr(paragraphs, "stage", lambda df, name, *a: made.append((name, stage(df, name, *a))) or made[-1][1])
    again, other, own = line(30), line(90), line(70)
    # equal shingles however often a text is repeated, so these share every bucket and are never listed as pairs
    docs = [(100 + i, " ".join([again] * (3 + i))) for i in range(paragraphs.SMALL + 2)] + [(10, other), (11, edited(other, 40)), (12, other), (13, own)]
    got = {r.doc_id: r.class_id for r in paragraphs.repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == dict.fromkeys(range(100, 102 + paragraphs.SMALL), 100) | dict.fromkeys((10, 11, 12), 10)
    (lines,) = [df for name, df in made if name == "paragraph-lines"]
    assert sorted(r.line for r in lines.collect()) == sorted({text for _, text in docs} - {own})


@pytest.mark.parametrize("most", [10_000, 1])
def test_large_classes_stay_spread(spark, most, monkeypatch):
    monkeypatch.setattr(paragraphs, "HOT", 20)
    monkeypatch.setattr(paragraphs, "MOST_HOT", most)
    common, usual, few = line(40), line(45), line(50)
    # own words next to what is shared, else a run over a line end may be equal by chance
    own = [f"own{i} {line(60)} own{i}" for i in range(180)]
    docs = [(i, "\n".join([common, own[i], *[usual] * (i % 2), own[90 + i], *[few] * (i % 30 == 3)])) for i in range(90)]
    found = paragraphs.repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(8))
    got = {r.doc_id: r for r in found.collect()}
    assert set(got) == set(range(90)) and {r.class_id for r in got.values()} == {0}
    for i, text in docs:
        keeps = {0: [common], 1: [usual], 3: [few]}.get(i, [])
        gone = [p for p in (common, *[usual] * (i % 2), *[few] * (i % 30 == 3)) if p not in keeps]
        assert got[i].removed == ",".join(f"{text.index(p)}:{text.index(p) + len(p)}" for p in gone)


def test_a_large_class_is_not_dealt_to_one_task(spark):
    n = 4 * paragraphs.HOT
    held = spark.range(n, numPartitions=8).selectExpr("IF(id % 4 = 0, id, -1L) AS cls", "id AS place")
    kept = held.groupBy("cls").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for tables too large to reach all tasks
    try:
        rows = paragraphs._with_first(held, kept)
        got = [(*map(int, r),) for r in rows.select("cls", "place", "first", F.spark_partition_id()).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert sorted(r[:3] for r in got) == sorted((i, i, i) if i % 4 == 0 else (-1, i, 1) for i in range(n))
    tasks = [t for cls, _, _, t in got if cls == -1]
    assert max(map(tasks.count, set(tasks))) < n / 4
