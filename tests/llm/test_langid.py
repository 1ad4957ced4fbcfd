import random
import zlib

import numpy as np
import pytest

from thalweg.llm import langid

WORDS = {
    "aa": ["maraba", "sol", "kite", "lomba", "ra", "zupe"],
    "bb": ["scht", "nicht", "öl", "dreng", "pforz", "ich"],
    "cc": ["дом", "река", "поле", "ещё", "над", "мир"],
}


def corpus(n, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(list(WORDS))
        rows.append((i, " ".join(r.choice(WORDS[lang]) for _ in range(r.randrange(1, 40))).title(), lang, "src"))
    return rows


def brute_trigrams(text):
    t = "".join(c if c.isalpha() else "\0" for c in f"\n{text.lower()}\n")
    return [t[i - 1 : i + 2] for i in range(1, len(t) - 1) if t[i] != "\0"]


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.createDataFrame(corpus(300), "doc_id long, text string, lang string, source string"))


def test_counts_equal_brute_force(spark):
    rows = corpus(60) + [(None, "Ünï!x  ab-c\n", "aa", None), (5, None, "aa", ""), (6, "", "bb", ""), (7, "x", None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want: dict = {}
    for _, text, lang, _ in rows:
        for g in brute_trigrams(text or "") if lang else ():
            want[lang, g] = want.get((lang, g), 0) + 1
    got = {}
    for r in langid.trigram_counts(df).collect():
        packed = r.gram % (1 << 64)
        got[r.lang, "".join(chr(packed >> s & 0x1FFFFF) for s in (42, 21, 0))] = r.n
    assert got == want


def test_held_out_accuracy(spark, model):
    rows = [(i, t, x) for i, t, x, _ in corpus(200, seed=2)]
    names, score = langid.predict_texts(model, [t for _, t, _ in rows])
    assert np.mean([a == x for a, (_, _, x) in zip(names, rows)]) > 0.98
    assert ((score >= 0) & (score <= 1)).all()


def test_slices_agree(model, monkeypatch):
    texts = [t for _, t, _, _ in corpus(50)] + [None, "", "123 !?", "x"]
    want = langid.predict_texts(model, texts)
    monkeypatch.setattr(langid, "STEP", 40)
    got = langid.predict_texts(model, texts)
    assert got[0] == want[0] and got[0][-4:] == ["und", "und", "und", got[0][-1]]


def test_no_false_negatives(model):
    false = model.false_rates
    assert (false < 0.01).all()
    h = np.array([1, 2, 3, 1 << 62], np.uint64)
    assert all((s < langid.SLOTS).all() for s in langid._places(h))


def test_identify(spark):
    rows = [*corpus(90), (None, "maraba", "aa", None), (3, None, "bb", None), (3, "", "bb", None), (4, "1.2", None, None)]
    rows = [(*r, "clash") for r in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score string")
    got = langid.identify(df).collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 == 1) for r in got)
    assert sorted(r.lang_pred for r in got if r.score == 0) == ["und"] * 3
    assert {r.lang_pred for r in got} == {"aa", "bb", "cc", "und"}
    assert langid.identify(df.limit(0)).count() == 0
    unlabelled = df.withColumn("lang", df.lang.substr(9, 1)).where("lang is null")
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} <= {"und"}


def brute_predict(rows, texts):
    """Plain sets in place of filters."""
    counts: dict = {}
    for text, lang in rows:
        for g in brute_trigrams(text):
            counts.setdefault(lang, {}).setdefault(g, 0)
            counts[lang][g] += 1
    shares = {x: {g: k / sum(n.values()) for g, k in n.items()} for x, n in counts.items()}
    most: dict = {}
    for each in shares.values():
        for g, k in each.items():
            most[g] = max(most.get(g, 0), k)
    held = {x: {g for g, k in each.items() if k >= langid.LEAST_SHARE and k >= langid.LEAST_RATIO * most[g]} for x, each in shares.items()}
    out = []
    for text in texts:
        grams = brute_trigrams(text)
        out.append(max(sorted(held), key=lambda x: sum(g in held[x] for g in grams)) if grams else "und")
    return out


def test_any_number_of_languages_equals_brute_force(spark):
    r = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzабвгдежзийклмнопрстуфхцч"
    words = {f"l{k:03}": ["".join(r.choice(letters) for _ in range(r.randrange(2, 7))) for _ in range(12)] for k in range(150)}
    rows = [(" ".join(r.choice(w) for _ in range(30)), x) for x, w in words.items() for _ in range(4)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == tuple(sorted(words)) and model.slots.shape == (3, langid.SLOTS)
    texts = [" ".join(r.choice(w) for _ in range(25)) for w in words.values()] + ["", "1 2"]
    got, score = langid.predict_texts(model, texts)
    assert got == brute_predict(rows, texts)
    assert np.mean([a == b for a, b in zip(got, words)]) > 0.99 and (score[:-2] > 0.5).all()
