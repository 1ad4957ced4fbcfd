import math
import random

import pytest
from pyspark.sql import functions as F

from thalweg.operators import nearest
from thalweg.operators.nearest import nearest_lines
from thalweg.operators.routes import closest_per_route

LINES = "linear_feature_id long, blue_line_key long, vertices array<struct<x:double,y:double,z:double,m:double>>"


def edge_distance(px, py, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    along, length2 = (px - a[0]) * dx + (py - a[1]) * dy, dx * dx + dy * dy
    if along <= 0:
        return (px - a[0]) ** 2 + (py - a[1]) ** 2, a[3]
    if along >= length2:
        return (px - b[0]) ** 2 + (py - b[1]) ** 2, b[3]
    across = (px - a[0]) * dy - (py - a[1]) * dx
    return across * across / length2, a[3] + along / length2 * (b[3] - a[3])


def brute(points, lines, k, radius):
    out = set()
    for p, x, y in points:
        best = []
        for i, _, v in lines:
            d2, m = min(edge_distance(x, y, a, b) for a, b in zip(v, v[1:]))
            if math.sqrt(d2) < radius:
                best.append((math.sqrt(d2), i, m))
        best = sorted(best)[:k]
        out |= {(p, i, round(d, 6), round(m, 6)) for d, i, m in best}
    return out


def found(spark, points, lines, **options):
    df = nearest_lines(
        spark.createDataFrame(points, "p long, x double, y double"),
        spark.createDataFrame(lines, LINES),
        by=["p"],
        **options,
    )
    return {(r.p, r.linear_feature_id, round(r.distance, 6), round(r.measure, 6)) for r in df.collect()}


def scatter(seed, n_points, n_lines, width, step=40.0, at=(0.0, 0.0)):
    rng = random.Random(seed)
    points = [(i, at[0] + rng.uniform(0, width), at[1] + rng.uniform(0, width)) for i in range(n_points)]
    lines = []
    for i in range(n_lines):
        x, y = at[0] + rng.uniform(0, width), at[1] + rng.uniform(0, width)
        v = []
        for j in range(rng.randint(2, 5)):
            v.append((x, y, 0.0, 10.0 * j))
            x, y = x + rng.uniform(-step, step), y + rng.uniform(-step, step)
        lines.append((i, i % 7, v))
    return points, lines


@pytest.mark.parametrize("cell", [None, 100.0, 470.0])
def test_sparse_lines_and_cell_size(spark, cell):
    points, lines = scatter(1, 60, 150, 1500.0, at=(-700.0, -700.0))
    lines.append((1000, 1, [(-900.0, -900.0, 0.0, 0.0), (2000.0, 1700.0, 0.0, 3900.0)]))
    lines.append((1001, 1, [(300.0, -900.0, 0.0, 0.0), (300.0, 1700.0, 0.0, 2600.0)]))
    got = found(spark, points, lines, k=5, radius=200.0, cell_size=cell)
    assert got == brute(points, lines, 5, 200.0) and got


def test_no_limit(spark):
    points, lines = scatter(2, 20, 80, 600.0)
    assert found(spark, points, lines, k=None, radius=150.0) == brute(points, lines, None, 150.0)


def test_dense_cells_are_searched_finely(spark, monkeypatch):
    """Points in, beside and far from a knot of lines, with lines of all lengths."""
    points, lines = scatter(3, 40, 120, 900.0)
    knot_points, knot_lines = scatter(4, 60, 400, 60.0, step=8.0, at=(401.0, 397.0))
    points += [(100 + p, x, y) for p, x, y in knot_points]
    lines += [(1000 + i, r, v) for i, r, v in knot_lines]
    lines.append((5000, 1, [(0.0, 0.0, 0.0, 0.0), (900.0, 880.0, 0.0, 1250.0)]))
    levels = []
    kept = nearest._search
    monkeypatch.setattr(nearest, "_search", lambda *a: levels.append(a[4]) or kept(*a))
    got = found(spark, points, lines, k=6, radius=300.0)
    assert got == brute(points, lines, 6, 300.0)
    assert len(levels) == 4 and levels == sorted(levels, reverse=True)


def test_copies_of_a_line(spark):
    """More copies than `k`: the lowest ids win, the rest don't crowd out anything."""
    points, lines = scatter(5, 10, 30, 300.0)
    same = [(150.0, 150.0, 0.0, 0.0), (160.0, 155.0, 0.0, 11.0)]
    lines += [(100 + i, 3, same) for i in range(50)]
    got = found(spark, points, lines, k=8, radius=250.0)
    assert got == brute(points, lines, 8, 250.0)


def test_hot_cells_change_nothing(spark):
    points, lines = scatter(6, 80, 60, 500.0)
    points = [(p, x / 10, y / 10) if p % 3 else (p, x, y) for p, x, y in points]
    plain = found(spark, points, lines, k=4, radius=120.0)
    assert found(spark, points, lines, k=4, radius=120.0, pairs_per_slice=5 * 400) == plain
    assert plain == brute(points, lines, 4, 120.0)


def test_a_cell_of_many_edges_is_sliced(spark):
    """Few points beside very many edges: the slices go by pairs, not by points."""
    points, lines = scatter(9, 12, 700, 90.0, step=5.0)
    listed = []
    kept = nearest.heaviest_keys

    def listing(*a, **b):
        listed.append(kept(*a, **b))
        return listed[-1]

    nearest.heaviest_keys = listing
    try:
        got = found(spark, points, lines, k=None, radius=100.0, pairs_per_slice=3_000)
    finally:
        nearest.heaviest_keys = kept
    assert got == brute(points, lines, None, 100.0)
    assert [(r.cx, r.cy, 2 <= r.slices <= 12) for r in listed[0].collect()] == [(0, 0, True)]


def test_edges_are_listed_in_cells_with_points_only(spark):
    points, lines = scatter(10, 60, 300, 2000.0)
    corner = [(p, x / 20, y / 20) for p, x, y in points]
    line_table = spark.createDataFrame(lines, LINES)
    edges = nearest.explode_edges(line_table, "linear_feature_id")

    def listed(some):
        located = nearest._in_cells(spark.createDataFrame(some, "p long, px double, py double"), ["p"], 50.0)
        return nearest._edge_cells(edges, 50.0, 50.0, nearest._masks(nearest._occupied(located)))

    every = listed([(i * 41 + j, i * 50.0 + 25, j * 50.0 + 25) for i in range(-8, 50) for j in range(-8, 50)])
    cells = {(int(x // 50), int(y // 50)) for _, x, y in corner}
    few = listed(corner)
    want = every.where(F.array(F.col("cx"), F.col("cy")).isin([F.array(F.lit(a).cast("long"), F.lit(b).cast("long")) for a, b in cells]))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, want.collect()))
    assert 0 < few.count() * 50 < every.count()
    assert found(spark, corner, lines, k=3, radius=50.0) == brute(corner, lines, 3, 50.0)


def test_radius_is_open_and_null_positions_drop(spark):
    line = [(1, 1, [(0.0, 0.0, 0.0, 0.0), (10.0, 0.0, 0.0, 10.0)])]
    points = [(1, 5.0, 100.0), (2, 5.0, 99.999), (3, None, 1.0)]
    assert found(spark, points, line, radius=100.0) == {(2, 1, 99.999, 5.0)}


def test_layout_does_not_matter(spark):
    points, lines = scatter(7, 40, 90, 500.0)
    first = found(spark, points, lines, k=5, radius=200.0)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert found(spark, points[::-1], lines[::-1], k=5, radius=200.0) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_ties_take_the_anchor_values(spark):
    rows = [
        (1, 7, 10, 5.0, 65.0, 100),
        (1, 8, 10, 5.0, 65.0, None),
        (1, 9, 10, 6.0, 70.0, 101),
        (1, 5, 11, 9.0, 1.0, 102),
        (1, 4, None, 1.0, 2.0, 103),
    ]
    df = spark.createDataFrame(
        rows, "p int, linear_feature_id long, blue_line_key long, distance double, measure double, waterbody_key long"
    )
    got = closest_per_route(df, by=["p"], anchored=["waterbody_key"]).orderBy("linear_feature_id").collect()
    assert [(r.linear_feature_id, r.anchor_id, r.measure, r.waterbody_key) for r in got] == [
        (5, 5, 1.0, 102),
        (7, 7, 65.0, 100),
        (8, 7, 65.0, 100),
    ]
