import random

import numpy as np
import pytest

from thalweg.llm import decontam

R = random.Random(5)
VOCABULARY = ["".join(R.choice("abcdefgh") for _ in range(R.randrange(1, 4))) for _ in range(150)]


def prose(n):
    return " ".join(R.choice(VOCABULARY) + ("." if R.random() < 0.1 else "") for _ in range(n))


ITEMS = [(i, prose(R.randrange(8, 60))) for i in range(60)] + [(60, None), (61, ""), (62, "too short"), (None, prose(30)), (64, ""), (0, prose(20))]


def brute_scores(index, terms):
    score = np.zeros(len(index.item_ids))
    for t in terms:
        at, x = index.postings[t]
        score[at] += x
    return score


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.9])
def test_wand_retrieves_all(threshold, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK", 3)
    index = decontam.build(ITEMS)
    for _ in range(60):
        terms = sorted(R.sample(range(len(index.keys)), R.randrange(1, 80)))
        score = brute_scores(index, terms)
        got = dict(decontam.search(index, terms, threshold))
        assert got.keys() == set(np.flatnonzero(score >= threshold).tolist()) and np.allclose([score[i] for i in got], list(got.values()))


def test_own_score_is_one():
    index = decontam.build(ITEMS)
    assert len(index.item_ids) == 63
    for i, text in ITEMS[:60]:
        assert any(index.item_ids[p] == i and s[0] > 0.999 for p, s in decontam.matches(index, text).items())


def test_contaminated(spark):
    docs = [(i, prose(200), "x") for i in range(20)]
    docs += [(100 + i, f"{prose(90)} {ITEMS[i][1].upper().replace(' ', '  ')}\n{prose(70)}", "x") for i in range(20)]
    docs += [(200, None, None), (201, "", ""), (None, ITEMS[5][1], ""), (202, prose(3000) + " " + ITEMS[7][1] + " " + prose(3000), "")]
    docs += [docs[25], (203, " ".join(ITEMS[9][1].split()[: len(ITEMS[9][1].split()) // 4]), "")]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()]
    want = [(100 + i, i) for i in range(20)] + [(None, 5), (202, 7), (105, 5)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    kept = decontam.clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [*range(20), 200, 201, 203]
    assert decontam.contaminated(df.limit(0), bench).count() == 0 and decontam.contaminated(df, bench.limit(0)).count() == 0


def test_items_of_few_words():
    items = [(0, "Paris"), (1, "Capital of France? Paris"), (2, "of France"), (3, "of France"), (4, "France of"), (5, "?!"), (6, prose(20))]
    index = decontam.build(items)

    def held(text):
        return {index.item_ids[i]: f[3] for i, f in decontam.matches(index, text).items()}

    assert held("The capital, of FRANCE: Paris. of France") == {0: 4, 1: 1, 2: 2, 3: 2}
    assert held("the capital of") == {} and held("?") == {} and held("of of france of") == {2: 1, 3: 1, 4: 2}
    R2 = random.Random(8)
    few = [(i, " ".join(R2.choice("abc") for _ in range(R2.randrange(1, 5)))) for i in range(40)]
    index = decontam.build(few)
    for _ in range(50):
        text = " ".join(R2.choice("abcd") for _ in range(R2.randrange(1, 12)))
        want = {i: f" {text} ".index(f" {x} ") // 2 for i, x in few if f" {x} " in f" {text} "}
        assert held(text) == want


def test_parts_tell_the_same(spark, monkeypatch):
    docs = [(i, f"{prose(60)} {ITEMS[i][1] if i % 2 else ''} {prose(40)} {'too short' if i % 5 == 0 else ''}", "x") for i in range(40)]
    df = spark.createDataFrame(docs + [(None, None, None), (50, "", "")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(ITEMS + ITEMS[:3], "item_id long, text string")
    want = sorted(map(str, decontam.contaminated(df, bench).collect()))
    kept = sorted(map(str, decontam.clean(df, bench).collect()))
    assert len(want) >= 28
    monkeypatch.setattr(decontam, "MOST_CHARACTERS", sum(len(x or "") for _, x in ITEMS) // 2)
    assert decontam.indexes(bench)[0] > 1
    assert sorted(map(str, decontam.contaminated(df, bench).collect())) == want
    assert sorted(map(str, decontam.clean(df, bench).collect())) == kept


def test_split():
    assert decontam.split("One two. Three?") == ("One two. ", "Three?")
    assert decontam.split("no end") == ("no end", "") and decontam.split("") == ("", "")
