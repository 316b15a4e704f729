"""BPE encoding and decoding by prefix-sharing trie traversal."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortry.llm.bpe import shipped, worker_codec
from cohortry.llm.common import table

#: Characters of text whose distinct words share one trie; bounds a worker's memory.
CHUNK_CHARS = 2_000_000


def encode(df: DataFrame, vocab_path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``ids``, the token ids of ``text`` as packed little-endian unsigned 32-bit integers, and ``decoded``, the text
    that these ids decode to.

    ``unpacked`` turns ``ids`` into an array. Null and empty texts have no ids and decode to the empty text. Special
    strings inside texts are one id. All other columns stay; columns named as the outputs are replaced. Repeated rows
    each get their result. A worker holds one trie over CHUNK_CHARS of text and a bounded cache. No shuffle.
    """
    raw = shipped(df.sparkSession, vocab_path)

    @arrow_udf("struct<ids: binary, decoded: string>")
    def codec(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie = worker_codec(raw.value)
        for batch in batches:
            for chunk in chunks(t.as_py() for t in batch):
                codes, texts = [], []
                for runs in trie.encode(chunk):
                    codes.append(b"".join(runs))
                    texts.append(trie.decode(codes[-1]))
                yield pa.StructArray.from_arrays([pa.array(codes, pa.binary()), pa.array(texts, pa.string())], ["ids", "decoded"])

    columns = [df[c] for c in df.columns if c not in (ids, decoded)]
    held = df.select(F.struct(*columns).alias("row"), codec(F.coalesce(df[text], F.lit(""))).alias("codec"))
    return held.select("row.*", F.col("codec.ids").alias(ids), F.col("codec.decoded").alias(decoded))


def chunks(texts: Iterable[str]) -> Iterator[list[str]]:
    """Lists of texts of CHUNK_CHARS characters, or one longer text."""
    chunk, size = [], 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def unpacked(ids: str = "ids"):
    """The packed ids as array<bigint>."""
    digits = F.hex(F.col(ids))
    places = F.when(F.length(digits) > 0, F.sequence(F.lit(1), F.length(digits) - 7, F.lit(8)))
    value = lambda at: F.conv(F.concat(*[F.substring(digits, at + k, F.lit(2)) for k in (6, 4, 2, 0)]), 16, 10).cast("long")
    return F.coalesce(F.transform(places, value), F.array().cast("array<bigint>"))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op9_bpe_codec": op9_bpe_codec}
