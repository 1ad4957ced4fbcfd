import random

import pytest

from thalweg.functions import is_descendant_or_self, path_label_after, path_prefixes
from thalweg.operators.paths import farthest_upstream, join_below, maximal_species


def below(code, ancestor):
    return code is not None and ancestor is not None and (code == ancestor or code.startswith(ancestor + "."))


def test_columns(spark):
    rows = [("9991", "999"), ("999", "999"), ("999.1", "999"), (None, "9"), ("9", None), ("", ""), ("a.bc.d", "a.b"), ("a.b.c.d", "a.b")]
    df = spark.createDataFrame(rows, "c string, a string")
    got = df.select(is_descendant_or_self("c", df.a).alias("b"), path_prefixes("c").alias("p"), path_label_after("c", df.a).alias("n")).collect()
    assert [r.b for r in got] == [False, True, True, None, None, True, False, True]
    assert got[7].p == ["a", "a.b", "a.b.c", "a.b.c.d"] and got[3].p is None and got[5].p == [""]
    assert [r.n for r in got] == [None, None, "1", None, None, None, None, "c"]


@pytest.mark.parametrize("or_self", [True, False])
@pytest.mark.parametrize("rows_per_slice", [1_000_000, 20])
def test_join_below(spark, or_self, rows_per_slice):
    r = random.Random(4)

    def code():
        return ".".join(["1", *(r.choice("012") for _ in range(r.randrange(5)))])

    upper = [(i, code()) for i in range(40)] + [(100, None), (101, "1"), (102, "1")]
    lower = [(i, code()) for i in range(300)] + [(1000, None), (1001, "12.0")]
    u, low = spark.createDataFrame(upper, "u long, code string"), spark.createDataFrame(lower, "l long, path string")
    got = join_below(u, low, upper_code="code", lower_code="path", by=["l"], or_self=or_self, rows_per_slice=rows_per_slice)
    mine = sorted((x.u, x.l) for x in got.collect())
    assert mine == sorted((i, j) for i, a in upper for j, c in lower if below(c, a) and (or_self or c != a))
    assert join_below(u, low.limit(0), upper_code="code", lower_code="path", by=["l"]).count() == 0


def upstream(b, a):
    """b lies upstream of a; both (species, route, measure, wscode, localcode)."""

    def spot(x):
        return x[4][len(x[3]) + 1 :].split(".")[0] if x[4] is not None and x[4].startswith(x[3] + ".") else ""

    if b[1] == a[1] and b[2] > a[2]:
        return True
    if a[3] is None or b[3] is None:
        return False
    if b[3] == a[3]:
        return spot(b) > spot(a)
    return b[3].startswith(a[3] + ".") and b[3][len(a[3]) + 1 :].split(".")[0] > spot(a)


SCHEMA = "species_code string, blue_line_key long, downstream_route_measure double, wscode string, localcode string, geom string"


def test_farthest_upstream(spark):
    r = random.Random(8)
    rows = []
    for _ in range(260):
        stream = ".".join(["1", *(r.choice(["010", "020", "030"]) for _ in range(r.randrange(4)))])
        local = r.choice([stream, None, f"{stream}.{r.choice(['005', '010', '015', '020', '030'])}", f"{stream}.015.7"])
        route = hash(stream) % 1000 + r.choice([0, 0, 0, 5000])
        rows.append((r.choice(["A", "B", "C"]), route, float(r.randrange(6)), stream, local, "x"))
    rows += [(None, 1, 1.0, "1", "1", "x"), ("A", None, 1.0, "1", "1", "x"), ("A", 1, None, "1.010", "1", "x"), ("D", 7, 1.0, None, None, "x")]
    rows += [("D", 7, 2.0, None, "1.2", "x"), ("E", 8, 0.0, "1", None, "x"), ("E", 9, 0.0, "1.010", None, "x")] + rows[:20]
    places = {x[:5] for x in rows if None not in x[:3]}
    want = sorted((x for x in places if not any(b[0] == x[0] and upstream(b, x) for b in places)), key=str)
    got = farthest_upstream(spark.createDataFrame(rows, SCHEMA)).collect()
    mine = [(x.species_code, x.blue_line_key, x.downstream_route_measure, x.wscode, x.localcode) for x in got]
    assert sorted(mine, key=str) == want
    assert 5 < len(want) < len(places)


def test_maximal_species(spark):
    rows = [("A", 1, 5.0, "1", "1.050", ""), ("B", 1, 5.0, "1", "1.050", ""), ("A", 2, 0.0, "1.060", "1.060", ""), ("X", 1, 5.0, "1", "1.050", "")]
    codes = spark.createDataFrame([(2, "A"), (1, "B"), (None, "X")], "species_id int, code string")
    observed = spark.createDataFrame(rows, SCHEMA)
    got = {(x.blue_line_key, x.downstream_route_measure): x.maximal_species for x in maximal_species(observed, codes).collect()}
    assert got == {(1, 5.0): [1], (2, 0.0): [2]}  # the tributary joins at 060, above both
    assert maximal_species(observed.limit(0), codes).count() == 0
