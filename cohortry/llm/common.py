"""What the training-data operators share: table access, staged tables and row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.staging import shared_dir, small, staged  # noqa: F401  shared with the rest of the library


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column, gap: str) -> Column:
    """The pieces between runs of the characters of class ``gap``; null has none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{gap}+", "")
    return F.filter(F.split(trimmed, f"{gap}+"), lambda w: w != "")


def settled(condition: Column) -> Column:
    """``condition``, made such that the optimizer does not copy what it is computed from into a filter below: that would
    compute nested array expressions once for each element."""
    return F.when(F.monotonically_increasing_id() >= 0, condition)


def crc32_sql(text: str, rows: str) -> str:
    """SQL twin of crc32, for DuckDB: common tables ``crcs``, the ``rows`` with ``crc``, the unsigned CRC-32 of ``text`` in UTF-8."""
    step = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    return f"""polynomial AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce([CAST(b AS BIGINT) FOR b IN range(8)], lambda c, b: {step}, CAST(i AS BIGINT)) AS v FROM range(256) AS r(i)) AS x),
crcs AS (SELECT * EXCLUDE (_b, t), xor(4294967295, list_reduce(_b, lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]), CAST(4294967295 AS BIGINT))) AS crc
  FROM (SELECT *, [CAST(concat('0x', h) AS BIGINT) FOR h IN regexp_extract_all(hex(encode({text})), '..')] AS _b FROM ({rows}) AS y) AS z, polynomial)"""
