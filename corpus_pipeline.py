"""A corpus pipeline of five of the operators in thalweg/llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thalweg.llm import decontam, langid, packing, pii, simhash
from thalweg.llm.registry import tokenizer_path
from thalweg.staging import stage


#: Chunks that packing remembers: its workers hold the earlier stages' models too.
REMEMBERED = 250_000


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without a letter, or without text, go."""
    known = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), langid.held_out("doc_id", 3, 1).alias("out"))
    model = langid.fit(known.where(~F.col("out")))
    told = langid.predict(docs, model, names=("__lang", "__score"))
    return told.where(F.col("__lang") != langid.UNKNOWN).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal fingerprints: the one with the smallest doc_id, NULL last."""
    return simhash.one_of_each_group(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing.pack(docs, tokenizer_path(), remembered=REMEMBERED)


STAGES = [
    ("language_id", languages),
    ("simhash_near_dedup", near_copies),
    ("decontamination", benchmark_free),
    ("pii", redacted),
    ("packing", packed),
]

#: DuckDB can't express these stages; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
