"""Nearest neighbours by inner product: inverted lists scanned with adaptive dimensions.

Largest inner product becomes smallest distance by one more dimension that lifts all
vectors to the same norm. Lists come from k-means on a bounded sample; every vector is
put into its list. Within each probed list the rotated vectors are read in column
blocks: after each block a pair's distance so far, scaled to all dimensions, is tested
against the query's best known k-th distance, and pairs that are
very likely farther are left. What survives all blocks is scored exactly on the
original vectors in double precision.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thalweg.staging import stage

#: Vectors that lists and first thresholds are fitted on, and the most lists.
SAMPLE, LISTS = 16_384, 1024
#: Share of the lists that a query reads, nearest centroids first.
PROBED = 0.75
#: A pair is left if its scaled distance is beyond (1 + CARE / sqrt(dimensions seen)) of the threshold's root.
CARE = 2.1
BLOCKS = (8, 16, 32)
#: Vectors and queries that meet in one task at a time.
VECTORS, QUERIES = 8192, 1024


@dataclass(frozen=True)
class Lists:
    centroids: np.ndarray
    rotation: np.ndarray
    reach: float  # the largest norm
    sample_ids: np.ndarray
    sample: np.ndarray

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Vectors to search among, with the dimension that gives all the same norm."""
        return np.column_stack([x, np.sqrt(np.maximum(self.reach**2 - (x * x).sum(axis=1), 0))])

    def order(self, x: np.ndarray) -> np.ndarray:
        """Of each lifted vector, the squared distances to the centroids less its own norm."""
        return (self.centroids**2).sum(axis=1) - 2 * x @ self.centroids.T


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """id and v (array of doubles), one row per id, of vectors that take part, and the exponent e of their scale.

    Without NULL ids, NULL or zero vectors, NULL or non-finite components, and lengths
    other than the most common one (ties: the shorter), between which there is no inner
    product. Of rows with the same id the smallest vector stays. Components are divided by
    2**e, so that the largest is about 1 and no square leaves the range of doubles.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    rows = rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("n", F.size("v"))
    rows = stage(rows.withColumn("most", F.array_max(F.transform("v", F.abs))), "ann-vectors")
    common = rows.groupBy("n").agg(F.count("*").alias("rows"), F.max("most").alias("most")).orderBy(F.desc("rows"), "n").first()
    e = max(-1000, min(1000, math.frexp(common.most)[1])) if common else 0
    scaled = F.transform("v", lambda x: x * F.lit(2.0**-e))
    return rows.where(F.col("n") == (common.n if common else 0)).select("id", scaled.alias("v")), e


def fit(rows: DataFrame) -> Lists | None:
    """Lists for `rows` (id, v); None if there are none."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, reach = rows.agg(F.count("*"), F.max(norm)).first()
    if not n:
        return None
    part = int(min(1.0, SAMPLE / n) * (1 << 20))
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < part).orderBy("id").toArrow()
    ids, x = sample["id"].to_numpy(), _matrix(sample["v"])
    rng = np.random.default_rng(3)
    if not len(x):  # a tiny share can miss all rows
        first = rows.orderBy("id").first()
        ids, x = np.array([first.id]), np.array([first.v], float)
    d = x.shape[1] + 1
    own = Lists(np.zeros((0, d)), np.linalg.qr(rng.standard_normal((d, d)))[0], float(reach) * (1 + 1e-12), ids, x)
    lifted = own.lifted(x)
    k = max(1, min(LISTS, len(x) // 16, round(math.sqrt(n))))
    centroids = lifted[rng.choice(len(x), k, replace=False)]
    for _ in range(8):
        nearest = ((centroids**2).sum(axis=1) - 2 * lifted @ centroids.T).argmin(axis=1)
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, lifted)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return Lists(centroids, own.rotation, own.reach, ids, x)


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def _blocks(d: int) -> list[tuple[int, int]]:
    cuts = [b for b in BLOCKS if b < d]
    return list(zip([0, *cuts], [*cuts, d]))


def scan(x: np.ndarray, q: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) of rotated rows that aren't told to be beyond the query's squared distance `limit`."""
    d = x.shape[1]
    (s, e), *more = _blocks(d)
    seen = (q[:, s:e] ** 2).sum(axis=1)[:, None] + (x[:, s:e] ** 2).sum(axis=1) - 2 * q[:, s:e] @ x[:, s:e].T

    def near(i, sofar, e):
        allowed = (1 + CARE / math.sqrt(e)) ** 2 if e < d else 1 + 1e-4
        return sofar * (d / e) <= limit[i] * allowed + 1e-4

    i, j = np.nonzero(near(np.arange(len(q))[:, None], seen, e))
    sofar = seen[i, j]
    for s, e in more:
        sofar = sofar + ((q[i, s:e] - x[j, s:e]) ** 2).sum(axis=1)
        keep = near(i, sofar, e)
        i, j, sofar = i[keep], j[keep], sofar[keep]
    return i, j


def nearest(q_ids, q, ids, x, lists: Lists, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query ids, ids and scores of each query's k best among x that may be among its k best at all."""
    xr = (lists.lifted(x) @ lists.rotation).astype(np.float32)
    qr = (np.column_stack([q, np.zeros(len(q))]) @ lists.rotation).astype(np.float32)
    out = []
    for s in range(0, len(q), 256):
        i, j = scan(xr, qr[s : s + 256], limit[s : s + 256].astype(np.float32))
        i = i + s
        other = q_ids[i] != ids[j]
        i, j = i[other], j[other]
        score = (q[i] * x[j]).sum(axis=1)
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.concatenate([[True], i[1:] != i[:-1]]) if len(i) else np.zeros(0, bool)
        rank = np.arange(len(i)) - np.maximum.accumulate(np.where(first, np.arange(len(i)), 0)) if len(i) else i
        top = rank < k
        out.append((q_ids[i[top]], ids[j[top]], score[top]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (q_ids[:0], ids[:0], np.zeros(0))


def search(vectors: DataFrame, every: int, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each row whose id is divisible by `every`, among all others.

    Ties go to the smaller id. With fewer than k candidates all are returned, and with
    none a query has no row. What takes part is told by `usable`; an empty table gives
    an empty result. Scores beyond the range of doubles are infinite or zero, but ranked as they are.
    """
    rows, e = usable(vectors, id_col, vector_col)
    lists = fit(rows)
    spark = vectors.sparkSession
    if lists is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # of equal vectors only the k + 1 smallest ids can be among anyone's k nearest
    same = Window.partitionBy("v").orderBy("id")
    kept = rows.withColumn("same", F.row_number().over(same)).where(F.col("same") <= k + 1).drop("same")
    probes = max(1, math.ceil(PROBED * len(lists.centroids)))

    def place(batches):
        for b in batches:
            x = lists.lifted(_matrix(b.column(1)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lists.order(x).argmin(axis=1).astype(np.int32))], ["id", "v", "list"])

    def probe(batches):
        # the sample's k best are found already, and the last of them bounds what else can be
        for b in batches:
            ids, q = b.column(0).to_numpy(), _matrix(b.column(1))
            for s in range(0, len(ids), 512):
                qs, own = q[s : s + 512], ids[s : s + 512]
                found = qs @ lists.sample.T
                found[own[:, None] == lists.sample_ids] = -np.inf
                top = np.argsort(-found, axis=1, kind="stable")[:, :k]
                best = np.take_along_axis(found, top, axis=1)
                real = np.isfinite(best)
                i = np.repeat(np.arange(len(qs)), real.sum(axis=1))
                exact = (qs[i] * lists.sample[top[real]]).sum(axis=1)
                cuts = pa.array(np.concatenate([[0], np.cumsum(real.sum(axis=1))]), pa.int32())
                best = np.where(real.sum(axis=1) == k, best[:, -1], -np.inf)
                limit = (qs * qs).sum(axis=1) + lists.reach**2 - 2 * best
                near = np.argsort(lists.order(np.column_stack([qs, np.zeros(len(qs))])), axis=1, kind="stable")[:, :probes]
                cols = [b.column(0).slice(s, 512), b.column(1).slice(s, 512), pa.array(limit), pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32()))]
                cols += [pa.ListArray.from_arrays(cuts, pa.array(lists.sample_ids[top[real]])), pa.ListArray.from_arrays(cuts, pa.array(exact))]
                yield pa.RecordBatch.from_arrays(cols, ["id", "v", "bound", "lists", "found", "scores"])

    listed = stage(kept.mapInArrow(place, "id long, v array<double>, list int"), "ann-lists")
    queries = rows.where(F.pmod("id", F.lit(every)) == 0).mapInArrow(probe, "id long, v array<double>, bound double, lists array<int>, found array<long>, scores array<double>")
    queries = stage(queries, "ann-queries")
    early = queries.select(F.col("id").alias("query_id"), F.explode(F.arrays_zip("found", "scores")).alias("f")).select("query_id", "f.found", "f.scores")
    queries = queries.select("id", "v", "bound", F.explode("lists").alias("list"))
    # both sides of a list are cut into blocks, and every block of one meets every block of the other
    x_blocks = listed.groupBy("list").agg(F.ceil(F.count("*") / VECTORS).cast("int").alias("nx"))
    q_blocks = queries.groupBy("list").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("nq"))
    blocks = F.broadcast(stage(x_blocks.join(q_blocks, "list"), "ann-blocks"))  # a row per list, of which there are LISTS at most
    part = F.xxhash64("id", F.lit(1))
    xs = listed.join(blocks, "list").select("list", F.pmod(part, "nx").alias("bx"), F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("bq"), "id", "v")
    qs = queries.join(blocks, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)).alias("bx"), F.pmod(part, "nq").alias("bq"), "id", "v", "bound")
    xs = xs.withColumns({c: F.col(c).cast("long") for c in ("bx", "bq")})
    qs = qs.withColumns({c: F.col(c).cast("long") for c in ("bx", "bq")})
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def meet(x: pa.Table, q: pa.Table) -> pa.Table:
        if not x.num_rows or not q.num_rows:
            return schema.empty_table()
        found = nearest(q["id"].to_numpy(), _matrix(q["v"]), x["id"].to_numpy(), _matrix(x["v"]), lists, q["bound"].to_numpy(), k)
        return pa.Table.from_arrays([pa.array(c) for c in found], schema=schema)

    by = ["list", "bx", "bq"]
    met = xs.groupBy(by).cogroup(qs.groupBy(by)).applyInArrow(meet, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    met = met.union(early).repartition("query_id").dropDuplicates(["query_id", "vec_id"])
    met = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return met.select("query_id", "rank", "vec_id", (F.col("score") * F.lit(2.0**e) * F.lit(2.0**e)).alias("score"))
