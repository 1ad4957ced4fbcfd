"""The registered queries of this subpackage: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thalweg.llm import ann, decontam, langid, maintext, merkle, packing, paragraphs, pii, runs, simhash, substrings, toxicity, urlfilter

#: The rules that the url contract states.
STATED_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x.kind, x.start, x.stop)), ",")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), every=20, k=20)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.detect(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeats(_table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = [urlfilter.domain_rule(action, rule) for action, rule in STATED_RULES]
    own = [urlfilter.word_rule("block", word) for word in urlfilter.UNWANTED]
    judged = urlfilter.judge(_table(spark, sf_dir, "pages"), urlfilter.rules(spark, stated + own))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.when(F.col("priority") > 0, F.col("rule")).alias("rule"),
        F.coalesce("action", F.lit("allow")).alias("verdict"),
    )


OP10_SQL = f"""
WITH parted AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT page_id, host, path,
    CASE WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parted)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
       WHEN rule IS NOT NULL THEN 'allow'
       WHEN regexp_matches(host, '(^|[.-])({"|".join(urlfilter.UNWANTED)})([.:-]|$)') THEN 'block'
       ELSE 'allow' END AS verdict
FROM ruled
"""


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(_table(spark, sf_dir, "pages"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH RECURSIVE leaf AS (
  SELECT d.doc_id, coalesce('=' || lang, '') AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY d.doc_id NULLS FIRST, own) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n, own,
    CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(d.doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 3 = 0
      THEN sha256(front || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) ELSE own END AS altered
  FROM (
    SELECT *, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS own
    FROM (SELECT *, concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
            coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS front FROM documents)) d),
node AS (
  SELECT tree, 0 AS level, pos, n, own AS digest FROM leaf
  UNION ALL
  SELECT tree, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY tree, level, pos // 8, n),
subroot AS (SELECT tree, level, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
upper AS (
  SELECT 0 AS level, pos, n, digest FROM subroot
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY level, pos // 8, n),
beside AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS ahead,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS behind
  FROM node a JOIN node b ON a.tree = b.tree AND a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY ALL
  UNION ALL
  SELECT s.tree, s.level + a.level, NULL, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), ''),
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '')
  FROM subroot s JOIN upper a ON a.pos = s.pos // CAST(pow(8, a.level) AS BIGINT) JOIN upper b ON a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.n > 1
  GROUP BY s.tree, s.level, a.level, a.pos),
folded AS (
  SELECT tree, pos AS leaf_pos, pos, 0 AS level, altered AS digest, '' AS proof FROM leaf
  UNION ALL
  SELECT f.tree, f.leaf_pos, f.pos // 8, f.level + 1, sha256(b.ahead || f.digest || b.behind), f.proof || b.ahead || b.behind
  FROM folded f JOIN beside b ON f.tree = b.tree AND f.level = b.level AND (b.pos IS NULL OR b.pos = f.pos))
SELECT l.doc_id, l.own AS leaf, s.digest AS subroot, u.digest AS root, sha256(f.proof) AS proof_sha256, f.digest AS folded_root, f.digest = u.digest AS verified
FROM leaf l JOIN subroot s USING (tree) JOIN (SELECT digest FROM upper WHERE n = 1) u ON true
JOIN (SELECT * FROM folded QUALIFY row_number() OVER (PARTITION BY tree, leaf_pos ORDER BY level DESC) = 1) f ON f.tree = l.tree AND f.leaf_pos = l.pos
"""


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic(_table(spark, sf_dir, "documents"), change=True).drop("runs")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": op1_pii,
        "op2_language_id": op2_language_id,
        "op3_nearest_neighbours": op3_nearest_neighbours,
        "op4_packing": op4_packing,
        "op5_simhash": op5_simhash,
        "op6_toxicity": op6_toxicity,
        "op7_repeated_strings": op7_repeated_strings,
        "op8_decontamination": op8_decontamination,
        "op9_paragraph_dedup": op9_paragraph_dedup,
        "op10_url_filters": op10_url_filters,
        "op11_main_text": op11_main_text,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_url_filters": OP10_SQL, "op12_merkle_manifest": OP12_SQL}
