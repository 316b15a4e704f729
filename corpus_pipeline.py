"""The corpus pipeline: five stages, each over what the one before kept.

Stages take (spark, docs, sf_dir), where docs has the columns of ``documents``: doc_id, text, lang, source, n_chars. All but
the last return these columns; other columns are not read.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.bpe_codec import encode
from cohortry.llm.common import small, staged, table
from cohortry.llm.decontaminate import decontaminate
from cohortry.llm.jaccard_join import one_of_each
from cohortry.llm.pii import fit_selector, pii_spans, redacted
from cohortry.llm.quality_rules import fitted_rules, quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned ones."""
    rules = fitted_rules(docs, table(spark, sf_dir, "labels"))
    return quality_rules(docs.select(COLUMNS), rules).where("kept").select(COLUMNS)


def by_similarity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose 5-word shingles have a Jaccard similarity of 0.8, the one with the least id."""
    return one_of_each(docs.select(COLUMNS), k=5, percent=80)


def by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    docs = docs.select(COLUMNS)
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    hit = staged(found.where("n_hit > 0").select(F.col("doc_id").alias("_id"), "digest").distinct(), "hit")
    hit = F.broadcast(hit) if small(hit) else hit
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("digest")), "left_anti").select(COLUMNS)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    docs = docs.select(COLUMNS)
    found = pii_spans(docs, fit_selector(docs))
    clean = found.withColumn("text", redacted(F.coalesce("text", F.lit("")), "spans"))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed as little-endian unsigned 32-bit integers, with digests of them and of their text."""
    coded = encode(docs.select(COLUMNS), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", by_quality),
    ("n-gram Jaccard join", by_similarity),
    ("benchmark decontamination", by_benchmark),
    ("PII", without_pii),
    ("BPE encoding and decoding", as_tokens),
]

#: Learned rules and token ids have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
