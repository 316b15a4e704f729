"""Token counts by heap-and-linked-list byte-pair merging."""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortry.llm.bpe import shipped, worker_counts
from cohortry.llm.common import table


def token_counts(df: DataFrame, vocab_path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """Add ``out``, the number of tokens of ``text`` under the byte-level BPE file at ``vocab_path``.

    Null and empty texts have 0 tokens. Special strings inside texts count as one token. All other columns stay; one
    named ``out`` is replaced. Repeated rows each get their count; an empty table gives an empty table. Counts of up to
    REMEMBERED words are kept in a worker, so its memory does not grow with the input. No shuffle.
    """
    raw = shipped(df.sparkSession, vocab_path)

    @arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = worker_counts(raw.value)
        for batch in batches:
            yield pa.array([counts.of_text(t.as_py()) for t in batch], pa.int64())

    return df.withColumn(out, count(F.coalesce(F.col(text), F.lit(""))))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 512).alias("over_limit"),
    )


QUERIES = {"op2_token_counts": op2_token_counts}
