"""Point geometries in well-known binary: read from sources without x and y columns, written for other tools.

Built-in expressions can't take a double out of bytes or make bytes of one, so these steps
run in Python, on Arrow batches.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Geometry types and the flags of the extended form.
POINT, MULTIPOINT = 1, 4
HAS_Z, HAS_M, HAS_SRID = 0x80000000, 0x40000000, 0x20000000

POINT_XY = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


@F.arrow_udf(T.ArrayType(POINT_XY))
def wkb_points(geometry: pa.Array) -> pa.Array:
    """The positions of a point or multi-point, in plain, ISO or extended form.

    Empty geometry gives an empty array, NULL gives NULL; another type stops the job.
    Points are read together by length and header, multi-points one by one.
    """
    geometry = geometry.cast(pa.large_binary())
    offsets = np.frombuffer(geometry.buffers()[1], np.int64)[geometry.offset : geometry.offset + len(geometry) + 1]
    data = np.frombuffer(geometry.buffers()[2] or b"", np.uint8)
    real = np.flatnonzero(geometry.is_valid().to_numpy(zero_copy_only=False))
    found_at, xs, ys = [], [], []
    lengths = np.diff(offsets)[real]
    for length in np.unique(lengths).tolist():
        rows = real[lengths == length]
        if length < 5:
            raise ValueError("geometry is cut off")
        heads = data[offsets[rows][:, None] + np.arange(5)]
        kinds, which = np.unique(heads, axis=0, return_inverse=True)
        for k, head in enumerate(kinds):
            own = rows[which.ravel() == k]
            kind, at, order = _header(head.tobytes(), 0)
            if kind == POINT:
                xy = data[offsets[own][:, None] + np.arange(at, at + 16)].reshape(-1).view(order + "f8").reshape(-1, 2)
                found_at.append(own)
                xs.append(xy[:, 0].astype(float))
                ys.append(xy[:, 1].astype(float))
            elif kind == MULTIPOINT:
                for i in own.tolist():
                    points = _parts(data[offsets[i] : offsets[i + 1]].tobytes(), at, order)
                    found_at.append(np.full(len(points), i))
                    xs.append(np.array([x for x, _ in points], float))
                    ys.append(np.array([y for _, y in points], float))
            else:
                raise ValueError(f"geometry type {kind} is neither a point nor a multi-point")
    at, x, y = (np.concatenate([np.zeros(0, t), *c]) for t, c in ((np.int64, found_at), (float, xs), (float, ys)))
    kept = ~(np.isnan(x) | np.isnan(y))  # an empty point is written with NaN coordinates
    order = np.flatnonzero(kept)[np.argsort(at[kept], kind="stable")]
    ends = np.searchsorted(at[order], np.arange(len(geometry) + 1)).astype(np.int32)
    points = pa.StructArray.from_arrays([pa.array(x[order]), pa.array(y[order])], ["x", "y"])
    return pa.ListArray.from_arrays(pa.array(ends), points, mask=geometry.is_null())


@F.arrow_udf(T.BinaryType())
def point_wkb(x: pa.Array, y: pa.Array, z: pa.Array, m: pa.Array) -> pa.Array:
    """Points in ISO well-known binary, little-endian, with the dimensions a row has: Z, M, both or none.

    NULL where x or y is NULL.
    """
    columns = [a.cast(pa.float64()) for a in (x, y, z, m)]
    there = [a.is_valid().to_numpy(zero_copy_only=False) for a in columns]
    values = np.stack([a.fill_null(0.0).to_numpy(zero_copy_only=False).astype("<f8") for a in columns], axis=1)
    placed = there[0] & there[1]
    code = np.where(placed, POINT + 1000 * there[2] + 2000 * there[3], 0)
    lengths = np.where(placed, 5 + 8 * (2 + there[2].astype(np.int64) + there[3]), 0)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    data = np.zeros(int(ends[-1]), np.uint8)
    for kind in np.unique(code[placed]).tolist():
        rows = np.flatnonzero(code == kind)
        kept = [0, 1] + [2] * bool(kind // 1000 & 1) + [3] * (kind // 1000 >= 2)
        head = np.frombuffer(struct.pack("<BI", 1, kind), np.uint8)
        body = np.ascontiguousarray(values[np.ix_(rows, kept)]).view(np.uint8).reshape(len(rows), -1)
        whole = np.concatenate([np.broadcast_to(head, (len(rows), 5)), body], axis=1)
        data[ends[rows][:, None] + np.arange(whole.shape[1])] = whole
    buffers = [pa.array(placed).buffers()[1], pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(placed), buffers).cast(pa.binary())


def with_wkb(df: DataFrame, geom: str = "geom", measure: str | None = None) -> DataFrame:
    """`df` with its position struct `geom` (x, y and perhaps z, m) as well-known binary; `measure` names a column for M."""
    fields = df.schema[geom].dataType.names

    def part(name: str) -> Column:
        return F.col(f"{geom}.{name}") if name in fields else F.lit(None).cast("double")

    m = part("m") if measure is None else F.col(measure).cast("double")
    return df.withColumn(geom, point_wkb(part("x"), part("y"), part("z"), m))


def _parts(wkb: bytes, at: int, order: str) -> list[tuple[float, float]]:
    (n,) = struct.unpack_from(order + "I", wkb, at)
    size = (len(wkb) - at - 4) // max(n, 1)
    out = []
    for i in range(n):
        _, start, own = _header(wkb, at + 4 + i * size)
        out.append(struct.unpack_from(own + "2d", wkb, start))
    return out


def _header(wkb: bytes, start: int) -> tuple[int, int, str]:
    order = "<" if wkb[start] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", wkb, start + 1)
    plain = code & ~(HAS_Z | HAS_M | HAS_SRID)
    return plain % 1000, start + (9 if code & HAS_SRID else 5), order
