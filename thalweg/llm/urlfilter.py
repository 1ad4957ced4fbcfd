"""URL rules found by their rarest literal token.

A rule names the literal tokens that every url it fits must hold; it is indexed
under the one that the fewest urls hold. A url's tokens fetch the rules indexed
under them, and only those rules' patterns run on it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULE_SCHEMA = "rule string, action string, priority int, pattern string, tokens array<string>"
#: Words that mark a host as unwanted, as hyphenated parts of its labels.
UNWANTED = ("adult", "bets", "casino", "poker", "porn", "spam", "viagra", "xxx")


def tokens(url: Column) -> Column:
    """The distinct runs of letters a to z and digits, after lower-casing A-Z."""
    return F.array_distinct(F.array_remove(F.split(_lower(url), "[^a-z0-9]+"), ""))


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def domain_rule(action: str, rule: str) -> tuple:
    """A rule `host/path`: the host and all its subdomains, paths that start with /path.

    The longest such rule that fits decides. Its tokens are those of the host and of
    the path's whole segments; a last segment without a slash may go on in the url.
    """
    name, _, rest = rule.partition("/")
    found = re.findall(r"[a-z0-9]+", name) + re.findall(r"[a-z0-9]+(?=[^a-z0-9])", rest.lower())
    return rule, action, 1000 + len(rule), rf"(?s)^(?:[^/]*\.)?{_literal(name)}/{_literal(rest)}", found


def word_rule(action: str, word: str) -> tuple:
    """Hosts that hold `word` between dots, hyphens and their ends; domain rules go first."""
    pattern = rf"(?s)^(?:[^/]*[.-])?{_literal(word)}(?:[.:/-]|$)"
    return word, action, 0, pattern, re.findall(r"[a-z0-9]+", word)


def _literal(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def rules(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RULE_SCHEMA)


def judge(pages: DataFrame, rule_table: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, and rule, action, priority of the rule that decides (else NULL), for every row.

    Patterns and tokens see the host followed by the path. The highest priority
    decides, then block, then the smallest rule. A NULL url, or one without `://`,
    has an empty host and path. Repeated rows and NULL ids stay. Rules that name no
    token are tried on every url.
    """
    url = F.col(url_col).cast("string")
    parted = pages.select(F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"))
    parted = parted.withColumn("subject", F.concat("host", "path"))
    return parted.join(_decided(parted.select("subject").distinct(), rule_table), "subject", "left").drop("subject")


def _decided(subjects: DataFrame, rule_table: DataFrame) -> DataFrame:
    by_token = subjects.select("subject", F.explode(F.array_append(tokens(F.col("subject")), "")).alias("token"))
    wanted = rule_table.withColumn("no", F.xxhash64("rule", "action", "priority", "pattern")).dropDuplicates(["no"])
    named = wanted.select("no", F.explode(F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))).alias("token"))
    held = by_token.join(named.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rarest = (
        named.join(held, "token", "left")
        .groupBy("no")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).getField("token").alias("token"))
    )
    indexed = wanted.drop("tokens").join(rarest, "no")
    fits = by_token.join(indexed, "token").where(F.expr("regexp_like(subject, pattern)"))
    best = F.min_by(F.struct("rule", "action", "priority"), F.struct(-F.col("priority"), F.col("action") != "block", "rule"))
    return fits.groupBy("subject").agg(best.alias("r")).select("subject", "r.*")
