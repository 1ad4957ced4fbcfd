"""A Merkle manifest of a corpus: a proof of membership for every row.

Every row is a leaf. The leaves of a language, in the order of their ids, are gathered
in runs of eight, the runs in runs again, up to one node, the subroot; the subroots
make the last tree in the same way. A node is labelled with the interval of leaf ranks
it covers, so intervals nest as nodes do, and on one level a node's bucket (its
first rank by the level's width) names the only node that can contain it.

The way up groups nodes by bucket. The way down joins the nodes of a level with
those above by bucket and containment; what a parent's interval holds beside a
node's own are the node's siblings. Every join key has at most eight rows, whatever
the languages' sizes, and each level has an eighth of the rows of the one below.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thalweg.staging import stage

RUN = 8
#: The columns of a leaf, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEPS = "array<struct<before: string, after: string>>"


def leaf_hash(**replaced: Column) -> Column:
    """The hash of a row: each column as `-` if NULL, else its byte count, `:` and its text."""
    parts = []
    for c in LEAF_COLUMNS:
        text = replaced.get(c, F.col(c)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return _hash(*parts)


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def tampered(text: str = "text", doc_id: str = "doc_id") -> Column:
    """The leaf of a row whose text had its A-Z lower-cased, for every third id by checksum; else NULL."""
    lowered = F.translate(F.col(text).cast("string"), _UPPER, _LOWER)
    chosen = F.crc32(F.col(doc_id).cast("string")) % 3 == 0
    return F.when(chosen, leaf_hash(**{text: lowered}))


def proofs(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """doc_id, leaf, altered, subroot, root, steps for every row of `docs`.

    `steps` has, from the leaf to the root, the digests of a run that stand before and
    after the node. `altered` is any other leaf to be folded along them.

    Leaves are ordered by doc_id, NULL first, then by their hash; equal rows are leaves of
    their own in any order. A NULL lang is a language of its own, the first one. An empty
    table gives no row. Columns other than `LEAF_COLUMNS` aren't read.
    """
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # NULL sorts before every language, as an empty text would
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        leaf_hash().alias("digest"),
        (F.lit(None).cast("string") if altered is None else altered).alias("altered"),
    )
    levels = _levels(stage(leaves, "merkle-leaves"), ["doc_id", "digest"])
    subroots = reduce(DataFrame.unionByName, [_tops(k, rows).select("tree", "digest") for k, rows in levels.items()])
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    upper = _levels(stage(named, "merkle-subroots"), ["name"])
    start = docs.sparkSession.range(1).select(F.lit("").alias("tree"), F.array().cast(_STEPS).alias("steps"), F.lit(None).cast("string").alias("up"))
    above = _down(upper, start).select(
        F.col("payload.name").alias("tree"), "steps", F.struct(F.col("payload.digest").alias("subroot"), F.col("top").alias("root")).alias("up")
    )
    found = _down(levels, stage(above, "merkle-above"))
    return found.select(
        "payload.doc_id", F.col("payload.digest").alias("leaf"), "payload.altered", "up.subroot", "up.root", "steps"
    )


def proof_hash(steps: str = "steps") -> Column:
    """The hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(leaf: Column, steps: str = "steps") -> Column:
    """The root that `leaf` and its siblings make."""
    return F.aggregate(steps, leaf, lambda node, s: _hash(s["before"], node, s["after"]))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of `docs`.

    The first five are those of the rows as they are. `folded_root` starts from the row after
    `tampered`, and `verified` tells whether it is the root all the same. Nulls, repeated rows
    and empty tables as in `proofs`; a NULL doc_id is never tampered with.
    """
    found = proofs(docs, tampered())
    refolded = found.withColumn("folded_root", folded(F.coalesce("altered", "leaf")))
    return refolded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_hash().alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _ranked(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """The leaves of every tree: tree, lo = hi = the rank in `order`, leaves (of the tree), digest, payload; and the largest tree's size.

    `rows` is a stored table. It is sorted in ranges, and ranks are the places in a range
    after the sizes of those before it, so that no task sorts or numbers a whole tree. Equal
    rows are told apart by their place in the stored table, and so are spread as well.
    """
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    keys = ["tree", *order, "_place"]
    at = F.monotonically_increasing_id()  # the range's number above 33 bits, the place in it below
    ordered = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_place").withColumn("_at", at)
    ordered = stage(ordered.withColumn("_range", F.shiftright("_at", 33)), "merkle-ranked")
    sizes = ordered.groupBy("tree", "_range").agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    before = sizes.select(
        "tree", "_range", "_first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"), F.sum("n").over(whole).alias("leaves")
    )
    before = stage(before, "merkle-ranges")
    rank = F.col("_before") + F.col("_at") - F.col("_first")
    payload = F.struct(*[c for c in rows.columns if c != "tree"])
    leaves = ordered.join(before, ["tree", "_range"]).select(
        "tree", rank.alias("lo"), rank.alias("hi"), "leaves", "digest", payload.alias("payload")
    )
    return leaves, before.agg(F.max("leaves")).first()[0] or 0


def _bucket(level: int, rank: str = "lo") -> Column:
    """The number of the only node of a level that can cover this rank."""
    return F.floor(F.col(rank) / F.lit(RUN**level)).cast("long")


def _nodes(level: int) -> Column:
    """How many nodes a tree has on a level."""
    return F.ceil(F.col("leaves") / F.lit(RUN**level))


def _levels(rows: DataFrame, order: list[str]) -> dict[int, DataFrame]:
    """The nodes of each level above the leaves: tree, lo, hi, leaves, digest, kids in order.

    The first level has a node for a lone leaf, too, with that leaf's digest.
    """
    below, most = _ranked(rows, order)
    levels: dict[int, DataFrame] = {}
    while not levels or RUN ** len(levels) < most:
        level = len(levels) + 1
        kid = F.struct("lo", "hi", "digest", *(["payload"] if level == 1 else []))
        runs = (
            (below if level == 1 else below.where(_nodes(level - 1) > 1))
            .groupBy("tree", _bucket(level).alias("bucket"))
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("leaves").alias("leaves"), F.sort_array(F.collect_list(kid)).alias("kids"))
        )
        joined = F.array_join("kids.digest", "")
        digest = F.when(F.col("leaves") == 1, joined).otherwise(F.sha2(joined, 256))
        below = levels[level] = stage(runs.select("tree", "lo", "hi", "leaves", digest.alias("digest"), "kids"), f"merkle-level-{level}")
    return levels


def _tops(level: int, rows: DataFrame) -> DataFrame:
    """The one node of each tree that ends on this level."""
    below = F.lit(True) if level == 1 else _nodes(level - 1) > 1
    return rows.where((_nodes(level) == 1) & below)


def _down(levels: dict[int, DataFrame], above: DataFrame) -> DataFrame:
    """payload, steps, top (the tree's last node) and up of every leaf; `above` has steps and up of each tree."""
    nodes: DataFrame | None = None
    for level in sorted(levels, reverse=True):
        ended = _tops(level, levels[level]).join(above, "tree")
        ended = ended.select("tree", "lo", "hi", "leaves", "kids", "steps", F.col("digest").alias("top"), "up")
        nodes = ended if nodes is None else ended.unionByName(_contained(levels[level], nodes, level + 1))
    leaf = nodes.select("leaves", "kids", F.explode("kids").alias("kid"), "steps", "top", "up")
    steps = F.when(F.col("leaves") == 1, F.col("steps")).otherwise(_steps(F.col("kids"), F.col("kid.lo"), F.col("kid.hi"), F.col("steps")))
    return leaf.select("kid.payload", steps.alias("steps"), "top", "up")


def _contained(nodes: DataFrame, parents: DataFrame, level: int) -> DataFrame:
    """Join nodes with the parent on `level` whose interval holds theirs; siblings become a step."""
    inner = nodes.where(_nodes(level - 1) > 1).withColumn("bucket", _bucket(level)).alias("n")
    outer = parents.withColumn("bucket", _bucket(level)).alias("p")
    held = (F.col("p.lo") <= F.col("n.lo")) & (F.col("n.hi") <= F.col("p.hi"))
    same = (F.col("n.tree") == F.col("p.tree")) & (F.col("n.bucket") == F.col("p.bucket"))
    steps = _steps(F.col("p.kids"), F.col("n.lo"), F.col("n.hi"), F.col("p.steps"))
    return inner.join(outer, same & held).select("n.tree", "n.lo", "n.hi", "n.leaves", "n.kids", steps.alias("steps"), "p.top", "p.up")


def _steps(kids: Column, lo: Column, hi: Column, above: Column) -> Column:
    """`above` after one more step: what `kids` cover before `lo` and after `hi`."""

    def joined(held) -> Column:
        return F.array_join(F.transform(F.filter(kids, held), lambda k: k["digest"]), "")

    own = F.struct(joined(lambda k: k["hi"] < lo).alias("before"), joined(lambda k: k["lo"] > hi).alias("after"))
    return F.concat(F.array(own), above)
