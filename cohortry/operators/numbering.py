"""Row numbers and running sums without a window over a whole group: rows are dealt out by range, and what a part needs to
know of the parts before it is a table with a row or two for each part."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.staging import small, staged

#: Bits that monotonically_increasing_id leaves for the row within its partition.
ROW_BITS = 33


def _ranged(df: DataFrame, order: list) -> DataFrame:
    """Rows in order, dealt to as many parts as shuffles have; equal rows may be in several parts."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    return tied.repartitionByRange(n, *order, "_tie")


def dealt(df: DataFrame, order: list, rows_per_task: int) -> DataFrame:
    """The rows, dealt out by range to tasks of about ``rows_per_task`` rows or fewer: what a task groups by ``order`` is then bounded
    and lies close together, in whatever order the files are and however large. Rows are counted first; if they are no more than
    that, they are left as they are."""
    rows = df.count()
    if rows <= rows_per_task:
        return df
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_task))
    return df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *order, "_tie").drop("_tie")


def numbered(df: DataFrame, order: list, *, by: list[str] = [], name: str = "number") -> DataFrame:  # noqa: B006
    """Adds ``name``: the place, from 1, of each row of its group (of all rows without ``by``) under ``order``.

    Rows that are equal in ``order`` have some order among them. A group of any size is spread over all parts. Null keys
    are a group. The table is staged once; an empty one gives an empty one.
    """
    rows = _ranged(df, [*by, *order]).sortWithinPartitions(*by, *order, "_tie").withColumn("_at", F.monotonically_increasing_id()).drop("_tie")
    rows = staged(rows.withColumns({"_part": F.shiftright("_at", ROW_BITS), "_at": F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)}), "numbered")
    before, total = [], 0
    for part, n in sorted(rows.groupBy("_part").count().collect()):  # a row for each part
        before.append((part, total))
        total += n
    offsets = df.sparkSession.createDataFrame(before, "_part long, _before long")
    placed = rows.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")
    if not by:
        return placed
    first = placed.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]).agg(F.min(name).alias("_first"))
    first = F.broadcast(first) if small(first) else first.hint("merge")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)])
    return placed.join(first, same).withColumn(name, F.col(name) - F.col("_first") + 1).drop("_first", *[f"_k{i}" for i in range(len(by))])


def running(df: DataFrame, by: list[str], order: list, sums: dict[str, Column]) -> DataFrame:
    """Adds, for each of ``sums``, the sum over the rows of the group up to and with the row itself, under ``order``.

    Sums are whole numbers; null counts as 0. Windows are over the rows of one group in one part; what they lack, the sums
    of the same group in earlier parts, is known for the first and the last group of a part alone: at most two rows a part.
    """
    made = df.withColumns({f"_s_{k}": F.coalesce(c, F.lit(0)).cast("long") for k, c in sums.items()})
    rows = staged(_ranged(made, [*by, *order]).withColumn("_part", F.spark_partition_id()), "running")
    within = Window.partitionBy("_part", *by).orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({k: F.sum(f"_s_{k}").over(within) for k in sums})
    key = F.struct(*by)
    edges = rows.groupBy("_part").agg(F.min(key).alias("_low"), F.max(key).alias("_high"))
    at_edge = rows.join(F.broadcast(edges), "_part").where(key.eqNullSafe(F.col("_low")) | key.eqNullSafe(F.col("_high")))
    totals = at_edge.groupBy("_part", *by).agg(*[F.sum(f"_s_{k}").alias(f"_t_{k}") for k in sums])
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], *[F.sum(f"_t_{k}").over(earlier).alias(f"_c_{k}") for k in sums])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)], F.col("_part") == F.col("_p"))
    met = local.join(F.broadcast(carried), same, "left")
    return met.select(*[c for c in df.columns if c not in sums], *[(F.col(k) + F.coalesce(f"_c_{k}", F.lit(0))).alias(k) for k in sums])
