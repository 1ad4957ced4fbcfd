"""Bounded nearest-lines join on a grid.

Every point falls in exactly one cell; every edge is listed in all cells that
its surroundings (within the search radius) touch and that hold a point. An equi-join on the cell
then meets every pair that can be within the radius, and the exact distance
decides. All later steps group by the cell as well, so the whole search moves
each side through one shuffle.

Three things keep that equi-join even and small; all are looked up beforehand in
small tables, and leave the plan alone where there is nothing to do:

* *Empty cells.* The cells with points are kept as bit masks, one number for a block of
  8 by 8 cells. Edges meet the masks of their blocks first, and are listed only in the
  cells whose bit is set. A network that points cover in part costs that part.
* *Hot cells.* The points of a cell where points times edges nearby are very many are
  spread over numbered slices, its edges are copied to each slice.
* *Dense cells.* Where a cell of a finer grid holds at least `k` line starts, the
  points in it have their k-th nearest line within the cell's diagonal. They
  are searched on that finer grid with the diagonal as radius, so their number
  of pairs stays in proportion to `k` and not to all lines within the radius.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thalweg.functions import explode_edges, measure_on_edge, squared_distance_to_edge
from thalweg.operators.skew import SLICE, copy_to_slices, heaviest_keys, spread
from thalweg.staging import stage

DEFAULT_K = 100
DEFAULT_RADIUS = 1500.0
PAIRS_PER_SLICE = 20_000_000

CELL = "cell"

_AT = ["cx", "cy"]
# the finer grids: how many, and how much finer each is than the one above
_LEVELS = 3
_FINER = 4
# squared distances are cut a little wide; the exact cut is on the distance
_LEEWAY = 1 + 1e-12
# cells of a block's side, and the edges near a cell that are reckoned with at least
_BLOCK = 8
_FEW_EDGES = 400


def nearest_lines(
    points: DataFrame,
    lines: DataFrame,
    *,
    by: Sequence[str],
    k: int | None = DEFAULT_K,
    radius: float = DEFAULT_RADIUS,
    cell_size: float | None = None,
    carry: Sequence[str] = (),
    flags: Mapping[str, Column] | None = None,
    needs: DataFrame | None = None,
    line_id: str = "linear_feature_id",
    keep_cell: bool = False,
    pairs_per_slice: int = PAIRS_PER_SLICE,
) -> DataFrame:
    """The `k` nearest lines of every point, nearer than `radius`; all if `k` is None.

    `points` has `x`, `y` and the `by` columns, which identify a point. `lines`
    has one row per `line_id`, with `vertices` and the `carry` columns. The result has `by`,
    `line_id`, `carry`, the planar `distance` and the `measure` (M) at the
    closest position. Ties at the k-th place go to the lowest id, ties within a
    line to the lowest measure. Points without a line in reach give no row.

    `flags` are further columns, worked out where point and line meet: from the `by` columns, the
    `carry` columns and those of `needs` (a table with one row per `line_id`, or none), which go no further.

    `keep_cell` adds the grid cell; grouping by it together with `by` reuses the
    partitioning of the result.
    """
    size = float(cell_size or radius)
    flags = dict(flags or {})
    more = [] if needs is None else [c for c in needs.columns if c != line_id]
    whole = lines if needs is None else lines.join(needs, line_id, "left")
    edges = explode_edges(whole, line_id, *carry, *more).drop("edge_no", "z1", "z2")
    starts = _line_starts(lines, size)
    dense = None if k is None else _dense_cells(starts, k)
    if dense is not None:
        edges = _without_spare_copies(edges, line_id, k)

    def search(located: DataFrame, cells: DataFrame, edge_cells: DataFrame, level: int, reach: float) -> DataFrame:
        hot = _busy_cells(cells, starts, level, pairs_per_slice)
        return _search(located, edge_cells, by, k, min(reach, radius), line_id, carry, flags, hot)

    x, y = F.col("x"), F.col("y")
    placed = points.where(x.isNotNull() & y.isNotNull()).select(*by, x.alias("px"), y.alias("py"))
    located = _in_cells(placed, by, size)
    cells = stage(_occupied(located), "occupied-cells")
    edge_cells = _edge_cells(edges, size, radius, _masks(cells))
    if dense is None:
        found = search(located, cells, edge_cells, 0, radius)
    else:
        found = _search_by_level(located, edge_cells, dense, by, size, radius, search)
    kept = ([CELL] if keep_cell else []) + [*by, line_id, *carry, *flags, "distance", "measure"]
    return found.where(F.col("distance") < radius).select(*kept)


def _search(
    located: DataFrame,
    edge_cells: DataFrame,
    by: Sequence[str],
    k: int | None,
    reach: float,
    line_id: str,
    carry: Sequence[str],
    flags: Mapping[str, Column],
    hot: DataFrame | None,
) -> DataFrame:
    """The `k` nearest lines no farther than `reach`, on one grid.

    The distance to a line found only beyond `reach` isn't settled, so rows
    there are left out.
    """
    left = spread(located, hot, _AT, by).select(_cell_id().alias(CELL), *by, "px", "py")
    right = copy_to_slices(edge_cells, hot, _AT).withColumn(CELL, _cell_id()).drop(*_AT, SLICE)
    found = left.hint("merge").join(right, CELL)

    edge = {c: F.col(c) for c in ("x1", "y1", "x2", "y2", "m1", "m2")}
    px, py = F.col("px"), F.col("py")
    group = [CELL, *by, line_id, *carry, *[c.alias(name) for name, c in flags.items()]]
    squared = squared_distance_to_edge(px, py, edge)
    pairs = found.where(squared <= F.lit(reach * reach * _LEEWAY)).select(
        *group, F.sqrt(squared).alias("distance"), measure_on_edge(px, py, edge).alias("measure")
    )
    closest_edge = Window.partitionBy(CELL, *by, line_id).orderBy("distance", "measure")
    per_line = pairs.withColumn("_place", F.row_number().over(closest_edge)).where("_place = 1").drop("_place")
    if k is None:
        return per_line
    nearest_first = Window.partitionBy(CELL, *by).orderBy("distance", line_id)
    placed = per_line.withColumn("_place", F.row_number().over(nearest_first))
    return placed.where(F.col("_place") <= k).drop("_place")


def _search_by_level(
    located: DataFrame,
    edge_cells: DataFrame,
    dense: DataFrame,
    by: Sequence[str],
    size: float,
    radius: float,
    search: Callable[[DataFrame, DataFrame, DataFrame, int, float], DataFrame],
) -> DataFrame:
    """Search every point on the finest grid whose cell around it is dense.

    A fine cell lies in one coarse cell, and an edge near the fine one is near
    the coarse one too. So each grid's edges come from those of the grid above,
    cut to its dense cells.
    """
    above = (F.floor(F.col(c) / _FINER).cast("long").alias(c) for c in _AT)
    parents = dense.where("level = 1").select(*above)
    edges = edge_cells.join(parents, _AT, "left_semi")
    rest, found, reach = located, [], radius

    def add(points: DataFrame, level: int) -> None:
        found.append(search(points, _occupied(points), edge_cells, level, reach))

    for level in range(1, _LEVELS + 1):
        coarse, finer = size / _FINER ** (level - 1), size / _FINER**level
        cells = dense.where(F.col("level") == level).select(*_AT)
        points = _in_cells(rest, by, finer)
        add(_in_cells(points.join(cells, _AT, "left_anti"), by, coarse), level - 1)
        rest = points.join(cells, _AT, "left_semi")
        reach = finer * 2**0.5 * (1 + 1e-9)
        edges = _to_finer_cells(edges, finer, reach).join(cells, _AT, "left_semi")
        edge_cells = edges
    add(rest, _LEVELS)
    return reduce(DataFrame.unionByName, found)


def _to_finer_cells(edges: DataFrame, size: float, reach: float) -> DataFrame:
    """Replace the cell of each row by those finer cells in it that are near the edge."""
    out = edges
    for cell, a, b in (("cx", "x1", "x2"), ("cy", "y1", "y2")):
        first = F.greatest(F.col(cell) * _FINER, _index(F.least(a, b) - reach, size))
        last = F.least(F.col(cell) * _FINER + (_FINER - 1), _index(F.greatest(a, b) + reach, size))
        near = out.withColumns({"_first": first, "_last": last}).where("_first <= _last")
        out = near.withColumn(cell, F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")
    return out


def _line_starts(lines: DataFrame, size: float) -> DataFrame:
    """How many lines start in each cell of the finest grid (`fx`, `fy`), and how many edges they have."""
    start = F.try_element_at(F.col("vertices"), F.lit(1))
    finest = size / _FINER**_LEVELS
    counts = (
        lines.where(F.size("vertices") > 1)
        .select(_index(start["x"], finest).alias("fx"), _index(start["y"], finest).alias("fy"), (F.size("vertices") - 1).alias("e"))
        .groupBy("fx", "fy")
        .agg(F.count("*").alias("n"), F.sum("e").alias("edges"))
    )
    return stage(counts, "line-starts")


def _dense_cells(starts: DataFrame, k: int) -> DataFrame | None:
    """Cells of the finer grids (`level`, `cx`, `cy`) that hold `k` line starts or more.

    None, without a table, where no cell does.
    """
    levels = F.explode(F.array(*[F.lit(j) for j in range(1, _LEVELS + 1)]))
    counts = (
        starts.withColumn("level", levels)
        .groupBy("level", *_above(F.lit(_LEVELS) - F.col("level")))
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= k)
        .select("level", *_AT)
    )
    return None if counts.isEmpty() else stage(counts, "dense-cells")


def _above(levels: Column) -> list[Column]:
    """The cells so many levels above the finest ones."""
    width = F.pow(F.lit(float(_FINER)), levels)
    return [F.floor(F.col(c) / width).cast("long").alias(a) for c, a in zip(("fx", "fy"), _AT)]


def _occupied(located: DataFrame) -> DataFrame:
    return located.groupBy(*_AT).agg(F.count("*").alias("n"))


def _busy_cells(cells: DataFrame, starts: DataFrame, level: int, pairs_per_slice: int) -> DataFrame | None:
    """Cells with very many pairs, and into how many slices their points are to be cut.

    Edges are reckoned by the lines that start in a cell or beside it. That needn't be
    exact: it decides on the layout only.
    """
    own = starts.groupBy(*_above(F.lit(_LEVELS - level))).agg(F.sum("edges").alias("e"))
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    beside = own.withColumn("_by", around).select((F.col("cx") + F.col("_by.i")).alias("cx"), (F.col("cy") + F.col("_by.j")).alias("cy"), "e")
    near = beside.groupBy(*_AT).agg(F.sum("e").alias("e"))
    pairs = F.col("n") * F.greatest(F.coalesce("e", F.lit(0)), F.lit(_FEW_EDGES))
    return heaviest_keys(cells.join(near, _AT, "left").withColumn("weight", pairs), _AT, pairs_per_slice, F.col("n"))


def _index(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(size)).cast("long")


def _in_cells(points: DataFrame, by: Sequence[str], size: float) -> DataFrame:
    x, y = F.col("px"), F.col("py")
    return points.select(*by, x, y, _index(x, size).alias("cx"), _index(y, size).alias("cy"))


def _cell_id() -> Column:
    """One number per cell and slice. Should two ever share a number, their
    pairs meet needlessly and the distance sorts them out."""
    return F.xxhash64(*_AT, SLICE)


def _without_spare_copies(edges: DataFrame, line_id: str, k: int) -> DataFrame:
    """Of every set of coinciding edges keep those of the `k` lowest line ids.

    A line further down the set always has `k` lines before it that are as near,
    so it can't be among the `k` nearest through this edge.
    """
    same = Window.partitionBy("x1", "y1", "x2", "y2").orderBy(line_id)
    # rank, so that a line that repeats an edge keeps all of its measures
    return edges.withColumn("_place", F.dense_rank().over(same)).where(F.col("_place") <= k).drop("_place")


def _masks(cells: DataFrame) -> DataFrame:
    """Per block (`bx`, `by`) of cells a number whose bits tell which of them are listed."""
    return cells.groupBy(*[_block(F.col(c)).alias(b) for c, b in zip(_AT, ("bx", "by"))]).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit())).alias("mask")
    )


def _block(cell: Column) -> Column:
    return F.floor(cell / _BLOCK).cast("long")


def _bit() -> Column:
    """The place of a cell in its block's mask."""
    return (F.pmod("cy", F.lit(_BLOCK)) * _BLOCK + F.pmod("cx", F.lit(_BLOCK))).cast("int")


def _edge_cells(edges: DataFrame, size: float, radius: float, masks: DataFrame) -> DataFrame:
    """Edges once per grid cell of `masks` that holds positions within `radius` of them.

    Blocks, and then cells, are walked column by column; in each column only the part of the
    edge that can reach it is looked at, so a long diagonal edge lists the cells
    along it and not its whole bounding box.
    """
    reach = radius * (1 + 1e-9) + 1e-6
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    west, east = _index(F.least(x1, x2) - reach, size), _index(F.greatest(x1, x2) + reach, size)

    def rows(column: Column, width: float) -> tuple[Column, Column]:
        """The first and last row of cells near the stretch of the edge whose x is within reach of a column."""
        run = F.nullif(x2 - x1, F.lit(0.0))
        left = (column * F.lit(width) - reach - x1) / run
        right = ((column + 1) * F.lit(width) + reach - x1) / run
        enter = F.greatest(F.lit(0.0), F.coalesce(F.least(left, right), F.lit(0.0)))
        leave = F.least(F.lit(1.0), F.coalesce(F.greatest(left, right), F.lit(1.0)))
        ya, yb = (y1 + t * (y2 - y1) for t in (enter, leave))
        return _index(F.least(ya, yb) - reach, size), _index(F.greatest(ya, yb) + reach, size)

    blocks = edges.withColumn("bx", F.explode(F.sequence(_block(west), _block(east))))
    south, north = rows(F.col("bx"), size * _BLOCK)
    blocks = blocks.withColumn("by", F.explode(F.sequence(_block(south), _block(north)))).join(masks, ["bx", "by"])
    first, last = F.col("bx") * _BLOCK, F.col("by") * _BLOCK
    columns = blocks.withColumn("cx", F.explode(F.sequence(F.greatest(first, west), F.least(first + _BLOCK - 1, east))))
    south, north = rows(F.col("cx"), size)
    within = columns.withColumns({"_south": F.greatest(last, south), "_north": F.least(last + _BLOCK - 1, north)})
    listed = within.where("_south <= _north").withColumn("cy", F.explode(F.sequence("_south", "_north")))
    held = listed.where(F.call_function("shiftright", F.col("mask"), _bit()).bitwiseAND(F.lit(1)) == 1)
    return held.drop("bx", "by", "mask", "_south", "_north")
