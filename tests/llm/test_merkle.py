import hashlib
import random
import zlib

import duckdb
import pytest

from thalweg.llm import merkle, registry

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def steps(tree, i):
    for nodes in tree[:-1]:
        first = i // 8 * 8
        yield "".join(nodes[first:i]), "".join(nodes[i + 1 : first + 8])
        i //= 8


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: levels([leaf(r) for r in own[x]]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    root, out = top[-1][0], []
    for k, x in enumerate(langs):
        for i, r in enumerate(own[x]):
            path = [*steps(trees[x], i), *steps(top, k)]
            changed = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                changed = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            node = leaf(changed)
            for before, after in path:
                node = digest(before, node, after)
            proof = digest(*(b + a for b, a in path))
            out.append((r[0], leaf(r), trees[x][-1][0], root, proof, node, node == root))
    return out


def table(sizes, seed=1):
    r = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            text = r.choice([None, "", "É Ü plain", "Some Words", "x" * r.randrange(300) + "Y"])
            rows.append((r.randrange(-50, 10**6), r.choice([None, "a:b", "-"]), lang, r.choice([None, 3]), text, "x", "y"))
    return rows


@pytest.mark.parametrize(
    "sizes", [{"a": 1}, {None: 1, "a": 8}, {"en": 600, "de": 65, "": 9, None: 64, "É": 2, "e": 1, "z": 513}, {str(i): 1 + i % 3 for i in range(70)}]
)
def test_manifest(spark, sizes):
    rows = table(sizes)
    if sum(sizes.values()) > 100:
        rows += [rows[0], rows[0], (None, None, "en", None, None, "x", "y"), (None, None, "en", None, "A", "x", "y"), rows[5]]
        rows += [(7, "s", "en", 1, f"t{i % 3}", "x", "y") for i in range(40)]
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = merkle.manifest(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_sql(spark):
    rows = table({"en": 300, "de": 9, None: 3, "fr": 1})
    unique = [*{r[0]: r for r in rows}.values()]
    docs = spark.createDataFrame(unique, SCHEMA)
    c = duckdb.connect()
    c.register("documents", docs.toPandas().astype({"n_chars": "Int64"}))
    assert sorted(map(tuple, c.execute(registry.OP12_SQL).fetchall()), key=str) == sorted(map(tuple, merkle.manifest(docs).collect()), key=str)


def test_empty_and_long(spark):
    docs = spark.createDataFrame([(1, "s", "en", 1, "Long Text " * 200_000, "", "")], SCHEMA)
    row = merkle.manifest(docs).first()
    assert row.root == row.leaf == row.subroot and row.proof_sha256 == digest("")
    assert merkle.manifest(docs.limit(0)).count() == 0
