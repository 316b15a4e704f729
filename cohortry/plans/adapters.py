"""Test tables in the roles of cohort data, and the same as SQL. Only integers are computed, so both engines agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bases of the island that reads lie on; number of genes, their spacing and length, so that neighbours overlap.
ISLAND, GENES, SPACING, GENE = 50_768, 19, 2_650, 2_900


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned reads: a line item is a read, an order a fragment, a supplier a sample."""
    li = table(spark, sf_dir, "lineitem")
    rest = [c for c in li.columns if c != "l_orderkey"]
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*rest))
    start = (F.col("l_partkey") * 1009 + F.col("l_orderkey") * 31) % ISLAND
    return li.select(
        F.col("l_suppkey").alias("sample_id"), F.col("l_orderkey").alias("fragment_id"), F.concat_ws("/", F.col("l_orderkey").cast("string"), n.cast("string")).alias("read_id"), n.cast("long").alias("ordinal"),
        start.cast("long").alias("start"), (start + 100 + F.col("l_quantity").cast("long")).cast("long").alias("end"), (F.round(F.col("l_tax") * 100).cast("int") * 5).cast("long").alias("mapq"),
        F.col("l_quantity").cast("long").alias("score"), F.round(F.col("l_discount") * 100).cast("long").alias("nm"), (F.col("l_linenumber") % 3).cast("long").alias("mate"),
        (F.when(F.col("l_returnflag") == "R", 4).otherwise(0) + F.when(F.col("l_linestatus") == "F", 16).otherwise(0) + F.when(F.col("l_linenumber") == 7, 256).otherwise(0) + F.when(F.col("l_linenumber") == 5, 1024).otherwise(0)).cast("long").alias("flag"),
        (F.col("l_partkey") % 7).cast("long").alias("contig"), F.col("l_partkey").alias("part"),
    )


def genes(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    return spark.range(GENES).select(F.concat(F.lit("g"), F.lpad((i + 1).cast("string"), 2, "0")).alias("gene"), (i * SPACING).alias("r_start"), (i * SPACING + GENE).alias("r_end"))


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as taxa: the parent of a key is its tenth, the root 0 is its own."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"), F.floor(F.col("p_partkey") / 10).cast("long").alias("parent"), F.when(F.col("p_partkey") == 0, "root").when(F.col("p_partkey") < 10, "family").when(F.col("p_partkey") < 100, "genus").when(F.col("p_partkey") < 1000, "species").otherwise("strain").alias("rank"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows: user, event type, whole value."""
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("sample_id"), F.col("event_type").alias("metric"), F.floor(F.col("value")).cast("long").alias("value"), F.col("event_id").alias("ordinal"))


READS = f"""reads AS (
  SELECT l_suppkey AS sample_id, l_orderkey AS fragment_id, concat(l_orderkey, '/', n) AS read_id, CAST(n AS BIGINT) AS ordinal,
    (l_partkey * 1009 + l_orderkey * 31) % {ISLAND} AS start, (l_partkey * 1009 + l_orderkey * 31) % {ISLAND} + 100 + CAST(l_quantity AS BIGINT) AS "end",
    CAST(round(l_tax * 100) AS BIGINT) * 5 AS mapq, CAST(l_quantity AS BIGINT) AS score, CAST(round(l_discount * 100) AS BIGINT) AS nm, CAST(l_linenumber % 3 AS BIGINT) AS mate,
    CAST(CASE WHEN l_returnflag = 'R' THEN 4 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 16 ELSE 0 END + CASE WHEN l_linenumber = 7 THEN 256 ELSE 0 END + CASE WHEN l_linenumber = 5 THEN 1024 ELSE 0 END AS BIGINT) AS flag,
    l_partkey % 7 AS contig, l_partkey AS part
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS n FROM lineitem) AS x)"""
GENE_ROWS = f"""genes AS (SELECT concat('g', lpad(CAST(i + 1 AS VARCHAR), 2, '0')) AS gene, i * {SPACING} AS r_start, i * {SPACING} + {GENE} AS r_end FROM range({GENES}) AS t(i))"""
OVERLAPS = f"""{READS}, {GENE_ROWS}, pairs AS (
  SELECT sample_id, fragment_id, read_id, flag, gene, least("end", r_end) - greatest(start, r_start) AS bases FROM reads JOIN genes ON start < r_end AND "end" > r_start),
sums AS (SELECT read_id, gene, any_value(sample_id) AS sample_id, any_value(fragment_id) AS fragment_id, any_value(flag) AS flag, CAST(sum(bases) AS BIGINT) AS bases FROM pairs GROUP BY read_id, gene),
assigned AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY bases DESC, gene) AS r FROM sums) AS x WHERE r = 1)"""
UNIONS = """unions AS (SELECT sample_id, CAST(sum(greatest("end" - greatest(start, coalesce(prev, start)), 0)) AS BIGINT) AS union_bases FROM (
  SELECT sample_id, start, "end", max("end") OVER (PARTITION BY sample_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM reads) AS x GROUP BY sample_id)"""
TREE = """tree AS (SELECT p_partkey AS node, p_partkey // 10 AS parent, CASE WHEN p_partkey = 0 THEN 'root' WHEN p_partkey < 10 THEN 'family' WHEN p_partkey < 100 THEN 'genus' WHEN p_partkey < 1000 THEN 'species' ELSE 'strain' END AS rank FROM part),
closure(node, ancestor, distance) AS (SELECT node, node, 0 FROM tree UNION ALL SELECT c.node, t.parent, c.distance + 1 FROM closure AS c JOIN tree AS t ON t.node = c.ancestor WHERE t.node <> t.parent)"""
EVENTS = """ev AS (SELECT user_id AS sample_id, event_type AS metric, CAST(floor(value) AS BIGINT) AS value, event_id AS ordinal FROM events)"""
