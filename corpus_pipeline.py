"""The corpus pipeline: documents through five operators, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.bpe import encode
from stratiform.llm.common import discard, marked, written, written_at
from stratiform.llm.decontaminate import decontaminate
from stratiform.llm.near_dedup import near_dedup
from stratiform.llm.quality import score_quality
from stratiform.llm.secrets import find_secrets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents below this calibrated probability of label 1 go.
QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that the quality classifier does not reject; the score stands beside each row, whatever its id."""
    scored = score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), beside=COLUMNS)
    return scored.filter(~(F.col("score") < QUALITY)).select([F.col(f"_{c}").alias(c) for c in COLUMNS])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near-duplicates; of rows that repeat an id and its text the least.

    The verdict belongs to an id and a text. Rows without an id are not copies of each other: the operator keeps them all.
    """
    docs = docs.select(COLUMNS).withColumn("text_hash", F.xxhash64("text"))
    decided = near_dedup(docs, beside=["text_hash"]).filter("doc_id is not null").groupBy("doc_id", F.col("_text_hash").alias("text_hash"))
    # what can't stay as it is: copies and repeated rows; only texts with their ids are shuffled
    special = written(decided.agg(F.min("kept").alias("kept"), F.count("*").alias("n")).filter("not kept or n > 1"), "pipeline-special")
    named = marked(docs.filter("doc_id is not null"), special)
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    others = named.filter("maybe").join(special.filter("not kept"), ["doc_id", "text_hash"], "left_anti")
    others = others.groupBy("doc_id", "text").agg(F.min(F.struct(rest)).alias("rest")).select("doc_id", "text", "rest.*")
    return named.filter("not maybe").select(COLUMNS).union(others.select(COLUMNS)).union(docs.filter("doc_id is null").select(COLUMNS))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    found = decontaminate(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(F.size("hits") == 0).select(COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts placeholders in the place of secrets; n_chars follows the text."""
    out = find_secrets(docs.select(COLUMNS), redacted="text")
    return out.select("doc_id", "text", "lang", "source", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and how many."""
    out = encode(docs.select(COLUMNS), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("secrets", secrets),
    ("tokens", tokens),
]
#: Signatures, the fitted classifier and BPE merges are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a written table that the next stage reads."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs, path = written_at(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last:
            discard(spark, last)  # its successor is written
        last = path
    return docs
