"""Personal data: base patterns, and bootstrapped contextual extraction on top.

A scan of every whole text gives the base matches (seeds) and the other tokens
that look like identifiers (candidates), each with its words to the left and right.
These induce lexical patterns: a shape, a context word on either side, or both; the
context words alone, or with a coarse class, meet values of shapes that no base match has. Spark
scores the graph of patterns and instances in rounds: a pattern's confidence in a
kind is the mean over its different instances, an instance's is that of its best
trusted pattern. Candidates trusted in the end are found wherever they occur.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from thalweg.staging import stage

KINDS = ("email", "ip", "card", "phone")
#: Bounds of a pattern that is trusted: different instances of the kind, and their share of its instances.
SUPPORT = 20
CONFIDENCE = 0.9
ROUNDS = 3

_LOCAL = r"[A-Za-z0-9._%+-]"
_AFTER_AT = r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
# A run of digits or local characters is tried at its first one only, which keeps
# long runs linear: any later start has the same rest. An e-mail's match may end
# inside a run, so the place where one ends is tried as well.
_EMAIL_HERE = re.compile(rf"{_LOCAL}++{_AFTER_AT}")
_EMAIL = re.compile(rf"{_LOCAL}(?<!{_LOCAL}{_LOCAL}){_LOCAL}*+{_AFTER_AT}")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"[A-Za-z0-9@._%+/-]{7,}")
# Numbers with up to three separators between digits, and addresses whose signs are spelled out or spaced.
_NUMBER = re.compile(r"(?<![\w@/.+-])(?:\+ ?)?\(?[0-9](?:[ ().-]{0,3}[0-9]){6,24}(?![\w@/])")
_AT = r"(?: ?[\[({<] ?(?:at|AT|@) ?[\])}>] ?| (?:at|AT) | ?@ ?)"
_DOT = r"(?: ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT) |\.)"
_SPELLED = re.compile(rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z0-9-]{{1,63}}+){{1,8}}")
_SIGN = re.compile(r"@|\b(?:at|AT)\b")
_WORD = re.compile(r"[^\W\d_]+")
#: Characters on either side that are looked at for context, and the longest value that takes part in the graph.
NEAR = 40
LONGEST = 64


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := _EMAIL_HERE.match(text, at) or _EMAIL.search(text, at):
        yield m.span()
        at = m.end()


def base(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; leftmost, non-overlapping within a kind."""
    found = [("email", *s) for s in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if len(m[0]) <= 37 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def shape(value: str) -> str:
    """Letters collapsed to `a`, digits to `9` each, the rest as it is."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"\d", "9", value))


def coarse(value: str) -> str:
    """A class that values of different shapes share: an address, or the number of digits in steps."""
    digits = len(_DIGIT.findall(value))
    return "@" if _SIGN.search(value) else "9" * sum(digits >= x for x in (1, 9, 13, 16, 20))


def _candidates(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of what looks like an identifier; they may overlap."""
    digits = _DIGIT.search(text)
    if "@" in text or digits:
        for m in _TOKEN.finditer(text):
            value = m[0].rstrip("._%+/-")
            if "@" in value or len(_DIGIT.findall(value)) >= 7:
                yield m.start(), m.start() + len(value)
    if digits:
        yield from (m.span() for m in _NUMBER.finditer(text))
    if _SIGN.search(text):
        yield from (m.span() for m in _SPELLED.finditer(text))


def occurrences(text: str, seeds: list[tuple[str, int, int]]) -> list[dict]:
    """Seeds and candidates with their shape and the words on either side; candidates have no kind."""
    spans = [(k, s, e) for k, s, e in seeds if e - s <= LONGEST]
    taken = sorted((s, e) for _, s, e in seeds)
    free = set()
    for s, e in _candidates(text):
        i = bisect_left(taken, (s, s))
        # base matches of four kinds that begin before `s` may reach over it
        if e - s <= LONGEST and not any(a < e and s < b for a, b in taken[max(0, i - 4) : i + 4]):
            free.add((s, e))
    spans += [(None, s, e) for s, e in sorted(free)]
    out = []
    for kind, s, e in spans:
        left, right = _WORD.findall(text[max(0, s - NEAR) : s])[-1:], _WORD.findall(text[e : e + NEAR])[:1]
        near = {"left": left[0].lower() if left else "", "right": right[0].lower() if right else ""}
        out.append({"kind": kind, "start": s, "stop": e, "value": text[s:e], "shape": shape(text[s:e]), "coarse": coarse(text[s:e])} | near)
    return out


_SPAN = [("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]
_SEEN = _SPAN + [(c, pa.string()) for c in ("value", "shape", "coarse", "left", "right")]
_SCAN = pa.schema(
    [("doc_id", pa.int64()), ("h", pa.int64())]
    + [(f"n_{k}", pa.int64()) for k in KINDS]
    + [("base_sha256", pa.string()), ("base", pa.list_(pa.struct(_SPAN))), ("seen", pa.list_(pa.struct(_SEEN)))]
)


def scan(docs: DataFrame) -> DataFrame:
    """One narrow row per document (doc_id, text): base matches, and what takes part in the graph."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                text = text.as_py() or ""
                found = base(text)
                n = {f"n_{k}": sum(x == k for x, _, _ in found) for k in KINDS}
                sha = hashlib.sha256(joined(found).encode()).hexdigest()
                spans = [{"kind": k, "start": s, "stop": e} for k, s, e in found]
                rows.append({"doc_id": doc_id, "h": h, "base_sha256": sha, "base": spans, "seen": occurrences(text, found)} | n)
            yield pa.RecordBatch.from_pylist(rows, _SCAN)

    return docs.select("doc_id", text_hash().alias("h"), "text").mapInArrow(run, from_arrow_schema(_SCAN))


def text_hash() -> Column:
    """Tells texts of the same id apart; NULL counts as empty."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def extras(scanned: DataFrame) -> DataFrame:
    """doc_id, h and extra, the discovered spans of each such document (which are few)."""
    seen = scanned.select("doc_id", "h", F.explode("seen").alias("o")).select("doc_id", "h", "o.*")
    patterns = F.array(
        F.col("shape"),
        F.concat(F.lit("<"), "left", F.lit(" "), "shape"),
        F.concat(F.lit(">"), "right", F.lit(" "), "shape"),
        *(
            F.when(F.col(side) != "", F.concat(F.lit(mark), side, *rest))
            for mark, side in (("<<", "left"), (">>", "right"))
            for rest in ((), (F.lit(" "), F.col("coarse")))
        ),
    )
    graph = stage(
        seen.select("value", "kind", F.explode(F.array_compact(patterns)).alias("pattern")).groupBy("pattern", "value").agg(F.max("kind").alias("seed")),
        "pii-graph",
    )
    return _spread(graph, seen)


def _spread(graph: DataFrame, seen: DataFrame) -> DataFrame:
    """Rounds over the graph (pattern, value, seed), then the places of trusted candidates."""
    seeds = graph.where("seed IS NOT NULL").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    known, size = seeds, F.count("*").alias("n")
    of_pattern = graph.groupBy("pattern").agg(size)
    open_values = graph.where("seed IS NULL").select("pattern", "value")
    found = None
    for _ in range(ROUNDS):
        scores = graph.select("pattern", "value").join(known, "value").groupBy("pattern", "kind")
        scores = scores.agg(F.sum("score").alias("score"), F.count("*").alias("support")).where(F.col("support") >= SUPPORT)
        trusted = scores.join(of_pattern, "pattern").select("pattern", "kind", (F.col("score") / F.col("n")).alias("score"))
        trusted = trusted.where(F.col("score") >= CONFIDENCE)
        best = F.max(F.struct("score", "kind")).alias("b")
        found = open_values.join(trusted, "pattern").groupBy("value").agg(best).select("value", "b.kind", "b.score")
        found = stage(found.join(seeds, "value", "left_anti"), "pii-found")
        known = seeds.union(found)
    places = seen.where("kind IS NULL").drop("kind").join(found.select("value", "kind"), "value")
    each = places.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set(F.struct("kind", "start", "stop"))).alias("extra"))
    # candidates may nest: the longest one of a kind stays
    longest = "filter(extra, x -> not exists(extra, y -> y.kind = x.kind and y.start <= x.start and y.stop >= x.stop and y != x))"
    return each.withColumn("extra", F.expr(longest))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, h, n_email, n_ip, n_card, n_phone, base_sha256 and spans for every row of `docs`.

    The counts and the hash are those of the base matches; `spans` (an array by kind,
    then start) adds the discovered ones. NULL texts count as empty, which have no
    match. Repeated rows and NULL ids stay; other columns aren't read. Values over
    64 characters are matched by the base patterns but take no part in the graph.
    """
    scanned = stage(scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))), "pii-scan")
    more = extras(scanned).select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "extra")
    order = F.array(*[F.lit(k) for k in KINDS])
    every = F.concat("base", F.coalesce("extra", F.expr("array()").cast("array<struct<kind:string,start:int,stop:int>>")))
    keyed = F.array_sort(F.transform(every, lambda x: F.struct(F.array_position(order, x.kind).alias("o"), x.start.alias("start"), x.stop.alias("stop"), x.kind.alias("kind"))))
    spans = F.transform(keyed, lambda x: F.struct(x.kind.alias("kind"), x.start.alias("start"), x.stop.alias("stop")))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h"))
    return scanned.join(more, same, "left").select("doc_id", "h", *[f"n_{k}" for k in KINDS], "base_sha256", spans.alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every found span of `text` replaced by its kind in brackets.

    Overlapping spans are replaced together, under the first one's kind. n_chars,
    where there is such a column, is that of the new text. NULL texts stay NULL.
    """
    found = extras(stage(scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))), "pii-scan"))
    more = stage(found.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), F.col("extra").alias("__extra")), "pii-extra")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (text_hash() == F.col("__h"))
    columns = docs.columns
    text_at = columns.index("text")
    chars_at = columns.index("n_chars") if "n_chars" in columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for text, extra in zip(b.column(text_at), b.column(len(columns)).to_pylist()):
                text = text.as_py()
                spans = base(text) + [(x["kind"], x["start"], x["stop"]) for x in extra or ()] if text else []
                texts.append(masked(text, spans) if spans else text)
            cols = list(b.columns[: len(columns)])
            cols[text_at] = pa.array(texts, cols[text_at].type)
            if chars_at is not None:
                n = [old if t is None else len(t) for t, old in zip(texts, cols[chars_at].to_pylist())]
                cols[chars_at] = pa.array(n, cols[chars_at].type)
            yield pa.RecordBatch.from_arrays(cols, columns)

    return docs.join(more, same, "left").select(*[docs[c] for c in columns], "__extra").mapInArrow(run, docs.schema)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2], KINDS.index(x[0]))):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]
