"""Constraints as tables of violations. An empty table means that the constraint holds; ``enforce`` raises otherwise."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cohortry.staging import small, staged


def duplicated(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def malformed(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose value is null or does not match the whole pattern."""
    return df.where(~F.coalesce(F.col(column).rlike(f"^(?:{pattern})$"), F.lit(False)))


def unknown(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Labels outside a fixed set, with their number of rows."""
    return df.where(~F.col(column).isin(allowed)).groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("rows"))


def missing(df: DataFrame, key: list[str], column: str, dimension: DataFrame) -> DataFrame:
    """Labels of the dimension that a group lacks: all that each group should have, less those it has. Labels are dealt to parts
    and every group asks every part, so neither a group nor a label is one task's; null keys are a group."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    labels = staged(dimension.select(column).distinct().withColumn("_part", F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")), "labels")
    few = small(labels)
    held = df.join(F.broadcast(labels) if few else labels, column, "left_semi").select(*key, column).distinct()
    groups = df.select(*key).distinct().withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    wanted = groups.join(F.broadcast(labels) if few else labels, "_part").drop("_part")
    same = reduce(lambda a, b: a & b, [F.col(f"w.{c}").eqNullSafe(F.col(f"h.{c}")) for c in [*key, column]])
    return wanted.alias("w").join(held.alias("h"), same, "left_anti").select(*key, column)


def id_problems(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """All that is wrong with ids, in one table: value, rows, problems (``malformed``, ``repeated`` or both). A null id is malformed; an id is
    looked at once, however many rows have it."""
    each = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    bad = ~F.coalesce(F.col("value").rlike(f"^(?:{pattern})$"), F.lit(False))
    found = F.concat_ws(";", F.when(bad, "malformed"), F.when(F.col("rows") > 1, "repeated"))
    return each.withColumn("problems", found).where(F.col("problems") != "")


def broken_rules(df: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """key and rule, for each row and each rule that it breaks, in one pass; a rule that is null for a row is not broken."""
    names = F.array_compact(F.array(*[F.when(broken, name) for name, broken in rules.items()]))
    return df.select(*key, F.explode(names).alias("rule"))


def passed(df: DataFrame, rules: dict[str, Column], name: str = "checked", shown: int = 5) -> DataFrame:
    """``df``, written once and read back, if no row breaks a rule. The rules are counted while the table is written, by
    observed metrics, so a table that is right costs no second pass; one that is not is refused with the count of every broken
    rule and some of its rows, all rules together."""
    watch = Observation(f"{name}-{uuid.uuid4().hex}")
    held = {k: F.coalesce(broken, F.lit(False)) for k, broken in rules.items()}
    out = staged(df.observe(watch, F.count(F.lit(1)).alias("rows of all"), *[F.count_if(broken).alias(k) for k, broken in held.items()]), name)
    counts = {k: n for k, n in watch.get.items() if n and k != "rows of all"}
    if counts:
        raise ValueError("; ".join(f"{k}: {n} rows, such as {[r.asDict() for r in out.where(held[k]).limit(shown).collect()]}" for k, n in counts.items()))
    return out


def parts_over_total(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Rows where a count exceeds the one that bounds it, with the name of the pair; nulls are skipped."""
    broken = F.filter(F.array(*[F.when(F.col(a) > F.col(b), f"{a}>{b}") for a, b in pairs]), lambda x: x.isNotNull())
    return df.withColumn("broken", F.explode(broken))


def not_ordered(df: DataFrame, chain: list[str]) -> DataFrame:
    """Rows whose values of a chain, such as quantiles, fall; nulls are skipped."""
    known = F.filter(F.array(*[F.col(c).cast("double") for c in chain]), lambda x: x.isNotNull())
    return df.where(F.array_sort(known) != known)


def not_conserved(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Groups whose number of rows changed between two steps: a group that one side lacks has 0 there."""
    one, two = (x.groupBy(*key).agg(F.count(F.lit(1)).alias(n)) for x, n in ((before, "before"), (after, "after")))
    both = one.join(two, key, "full").na.fill(0, ["before", "after"])
    return both.where("before <> after")


def too_many_duplicates(df: DataFrame, by: list[str], name: str, tolerance: float = 0.001) -> DataFrame:
    """Groups in which more than ``tolerance`` of the rows repeat a name; names are counted before groups meet."""
    each = df.groupBy(*by, name).agg(F.count(F.lit(1)).alias("_n"))
    found = each.groupBy(*by).agg(F.sum("_n").cast("long").alias("rows"), F.sum(F.col("_n") - 1).cast("long").alias("repeats"))
    return found.where(F.col("repeats") > tolerance * F.col("rows"))


def not_falling(df: DataFrame, chain: list[str]) -> DataFrame:
    """Rows where a later count of a chain exceeds the one before it; nulls are skipped."""
    known = F.filter(F.array(*chain), lambda x: x.isNotNull())
    rises = F.exists(F.sequence(F.lit(1), F.greatest(F.size(known) - 1, F.lit(1))), lambda i: F.coalesce(F.get(known, i) > F.get(known, i - 1), F.lit(False)))
    return df.where(rises)


def not_sum(df: DataFrame, parts: list[str], total: str) -> DataFrame:
    """Rows whose parts, all present, do not add up."""
    return df.where(reduce(lambda a, b: a + b, map(F.col, parts)) != F.col(total))


def out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.where((F.col(column) < low) | (F.col(column) > high))


def several(df: DataFrame, key: list[str], column: str) -> DataFrame:
    """Groups with more than one value."""
    return df.groupBy(*key).agg(F.countDistinct(column).alias("kinds")).where("kinds > 1")


def disagreeing(a: DataFrame, b: DataFrame, key: list[str], column: str) -> DataFrame:
    """Keys whose value differs between two computations."""
    return a.select(*key, F.col(column).alias("one")).join(b.select(*key, F.col(column).alias("two")), key).where(~F.col("one").eqNullSafe(F.col("two")))


def far_apart(df: DataFrame, one: str, two: str, share: float = 0.05, least: float = 2) -> DataFrame:
    """Rows whose two values differ by more than a share of the first and more than ``least``."""
    return df.where(F.abs(F.col(one) - F.col(two)) > F.greatest(F.lit(least), F.abs(F.col(one)) * share))


def shared(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Values that must not be on both lists."""
    return a.select(column).intersect(b.select(column))


def enforce(violations: dict[str, DataFrame], shown: int = 10) -> None:
    """Raise one error that names every constraint broken, with its first rows."""
    found = {name: df.limit(shown).collect() for name, df in violations.items()}
    if broken := {name: rows for name, rows in found.items() if rows}:
        raise ValueError("; ".join(f"{name}: {[r.asDict() for r in rows]}" for name, rows in broken.items()))
