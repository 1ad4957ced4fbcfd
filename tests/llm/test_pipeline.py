import random
import re

import pytest

import corpus_pipeline
from tests.llm.test_simhash import brute_fingerprint, brute_groups
from thalweg.llm import decontam, pii

R = random.Random(11)
VOCABULARY = ["".join(R.choice("abcdefghijklmnop") for _ in range(R.randrange(2, 8))) for _ in range(400)]


def prose(n):
    return " ".join(R.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    bench = [(i, prose(30) + ". " + prose(12)) for i in range(5)]
    texts = [prose(60) for _ in range(30)]
    rows = [(i, t, "aa" if i % 2 else "bb", f"s{i}", len(t)) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i], "aa", "copy", len(texts[i])) for i in range(5)]
    rows += [(200 + i, f"{prose(40)} {bench[i][1]} {prose(20)}", "bb", "leak", 5) for i in range(3)]
    rows += [(300, prose(20) + " a@b.cd " + prose(20), "aa", "pii", 7), (301, "12 34 !!", "aa", "x", 8), (302, None, "aa", "x", None), (303, "", None, None, 0)]
    rows += [(None, texts[0] + " extra words", "aa", "n", 3), (None, prose(50), "bb", "n", 3), rows[7]]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "decontamination", "pii", "packing"]
    before = rows_of(docs)

    kept = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    assert kept.columns == columns
    want = [r for r in before if r[1] and re.search("[a-z]", r[1])]
    assert rows_of(kept) == want

    one = corpus_pipeline.STAGES[1][1](spark, kept, sf_dir)
    assert one.columns == columns
    groups = brute_groups([(r[0], brute_fingerprint(r[1])) for r in want])
    expected = {(d, f) for d, f, c in groups if d == c}
    got = rows_of(one)
    assert sorted(map(str, ((r[0], brute_fingerprint(r[1])) for r in got))) == sorted(map(str, expected))
    assert set(got) <= set(want)

    clean = corpus_pipeline.STAGES[2][1](spark, one, sf_dir)
    assert clean.columns == columns
    bench = decontam.build([tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()])
    leaked = [r for r in got if any(item in " ".join(r[1].split()) for item in (t for _, t in BENCH(spark, sf_dir)))]
    assert len(leaked) == 3 and bench.stride > 40
    assert rows_of(clean) == [r for r in got if r not in leaked]

    masked = corpus_pipeline.STAGES[3][1](spark, clean, sf_dir)
    assert masked.columns == columns
    for old, new in zip(sorted(rows_of(clean), key=lambda r: str((r[0], r[3]))), sorted(rows_of(masked), key=lambda r: str((r[0], r[3])))):
        text = pii.masked(old[1], pii.base(old[1]))
        assert new == (old[0], text, old[2], old[3], len(text) if old[1] is not None else old[4]) or new == old

    pieces = corpus_pipeline.STAGES[4][1](spark, masked, sf_dir).collect()
    assert {p.doc_id for p in pieces} == {r[0] for r in rows_of(masked)}
    assert sum(p.length for p in pieces) == sum({(p.doc_id, p.doc_tokens, p.ids_crc32 if p.doc_id is None else 0): p.doc_tokens for p in pieces}.values())


def BENCH(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]


def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, sf_dir)
    assert sum(p.length for p in docs.collect()) == sum(p.length for p in corpus_pipeline.run(spark, sf_dir).collect())


def test_empty_and_extra_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("*", "1.5d AS score", "'x' AS fp", "doc_id AS node", "text AS h")
    for _, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes and out.count() > 0
        assert function(spark, docs.limit(0), sf_dir).count() == 0


