"""Best rows under explicit orders and tie rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def largest_overlap(pairs: DataFrame, key: list[str], label: str, bases: str, *, floor: int = 1, tie: str = "first", mark: str | None = None) -> DataFrame:
    """The label with the most summed bases for each key. ``tie``: 'first' takes the least label, 'drop' takes none.
    ``mark``: a column that says whether one label alone has the most."""
    sums = pairs.groupBy(*key, label).agg(F.sum(bases).cast("long").alias(bases)).where(F.col(bases) >= floor)
    # of the labels with the most bases the least and the greatest: they differ on ties
    found = sums.groupBy(*key).agg(F.min(F.struct((-F.col(bases)).alias("_b"), label)).alias("_low"), F.max(F.struct(bases, label)).alias("_high"))
    alone = F.col(f"_low.{label}") == F.col(f"_high.{label}")
    found = found.where(alone) if tie == "drop" else found
    return found.select(*key, F.col(f"_low.{label}").alias(label), F.col(f"_high.{bases}").alias(bases), *([alone.alias(mark)] if mark else []))


def best_hit(hits: DataFrame, key: list[str], label: str, order: list[Column], *, qualifies: Column | None = None) -> DataFrame:
    """For each key the labels that rank first under ``order``: status assigned with one label, ambiguous with more. Hits that do
    not qualify (such as those over the greatest E-value) are left out before they are ranked; a key without any is not listed."""
    hits = hits if qualifies is None else hits.where(qualifies)
    w = Window.partitionBy(*key).orderBy(*order)
    top = hits.withColumn("_r", F.rank().over(w)).where("_r = 1").groupBy(*key).agg(F.countDistinct(label).alias("labels"), F.min(label).alias("_l"))
    return top.select(*key, F.when(F.col("labels") == 1, F.col("_l")).alias(label), "labels", F.when(F.col("labels") == 1, "assigned").otherwise("ambiguous").alias("status"))


def first_by(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; ``order`` must be total."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def carrier_calls(best: DataFrame, key: list[str], label: str, score: str, *, least_lead: int = 1, margin: int = 0) -> DataFrame:
    """One call a key from its best score for each label: attributed if no other label is within ``margin`` of the top and the
    runner-up, if any, is ``least_lead`` behind; else ambiguous. Labels rank by score, then name. Columns: call, top,
    top_score, runner_up, runner_up_score, lead, within_margin, tied (sorted). A key's labels are those of the panel.
    """
    ranked = F.sort_array(F.collect_list(F.struct((-F.col(score)).alias("s"), F.col(label).alias("l"))))
    held = best.groupBy(*key).agg(ranked.alias("_r"))
    one, two = F.get("_r", F.lit(0)), F.get("_r", F.lit(1))
    tied = F.array_sort(F.transform(F.filter("_r", lambda x: x["s"] - one["s"] <= margin), lambda x: x["l"]))
    out = held.select(*key, one["l"].alias("top"), (-one["s"]).alias("top_score"), two["l"].alias("runner_up"), (-two["s"]).alias("runner_up_score"), (two["s"] - one["s"]).alias("lead"), F.size(tied).alias("within_margin"), tied.alias("tied"))
    resolved = (F.col("within_margin") == 1) & (F.col("lead").isNull() | (F.col("lead") >= least_lead))
    return out.withColumn("call", F.when(resolved, "attributed").otherwise("ambiguous"))


def top_and_runner_up(df: DataFrame, key: list[str], label: str, score: str, margin: int) -> DataFrame:
    """Top label (least on ties), its score, the lead over the next, and the labels within ``margin`` of the top."""
    w = Window.partitionBy(*key).orderBy(F.col(score).desc(), F.col(label))
    ranked = df.withColumns({"_r": F.row_number().over(w), "_next": F.lead(score).over(w), "_top": F.max(score).over(Window.partitionBy(*key))})
    one = lambda c: F.max(F.when(F.col("_r") == 1, F.col(c)))
    return ranked.groupBy(*key).agg(
        one(label).alias("top"), one(score).alias("top_score"), one("_next").alias("_n"), F.count_if(F.col("_top") - F.col(score) <= margin).alias("within_margin"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("_top") - F.col(score) <= margin, F.col(label).cast("string")))), ";").alias("tied"),
    ).withColumn("delta", F.col("top_score") - F.col("_n")).drop("_n")


def precedence(df: DataFrame, key: list[str], label: str, ranks: list[str]) -> DataFrame:
    """The label of each key that comes first in ``ranks``."""
    names = F.array(*map(F.lit, ranks))
    return df.groupBy(*key).agg(F.element_at(names, F.min(F.array_position(names, F.col(label))).cast("int")).alias(label))


def first_missing(df: DataFrame, key: list[str], stages: dict[str, str]) -> DataFrame:
    """The first stage, in order, whose column is null."""
    out = F.lit(None).cast("string")
    for stage, column in reversed(stages.items()):
        out = F.when(F.col(column).isNull(), stage).otherwise(out)
    return df.select(*key, out.alias("first_missing"))


def paired(df: DataFrame, fragment: list[str], mate: str, order: list[Column]) -> DataFrame:
    """Slot of each read: 'pair' for the first of each mate where both mates exist, else 'single'."""
    w = Window.partitionBy(*fragment, mate).orderBy(*order)
    slot = df.withColumn("_n", F.row_number().over(w))
    both = Window.partitionBy(*fragment)
    has = lambda m: F.max(F.when((F.col(mate) == m) & (F.col("_n") == 1), 1).otherwise(0)).over(both)
    return slot.withColumn("slot", F.when((F.col("_n") == 1) & (has(1) == 1) & (has(2) == 1) & F.col(mate).isin(1, 2), "pair").otherwise("single")).drop("_n")


def every_kth(df: DataFrame, by: list[str], order: list[Column], cap: int, part: Column | None = None) -> DataFrame:
    """A systematic sample of each group: every k-th row with k = ceil(n / cap), from the first, at most ``cap``.

    ``part`` is a value that never falls along the order, such as a range of its first column: a row's place is then its
    place in the part plus the rows of the parts before, which are counted, and no task sorts a whole group."""
    df = df.withColumn("_part", F.lit(0) if part is None else part)
    w = Window.partitionBy(*by)
    counts = df.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_c"))
    before = F.coalesce(F.sum("_c").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = counts.select(*by, "_part", before.alias("_before"), F.greatest(F.ceil(F.sum("_c").over(w) / cap), F.lit(1)).alias("_k"))
    place = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order)) - 1
    placed = df.withColumn("_i", place).join(parts, [*by, "_part"]).withColumn("_i", F.col("_i") + F.col("_before"))
    return placed.where((F.col("_i") % F.col("_k") == 0) & (F.col("_i") / F.col("_k") < cap)).drop("_i", "_k", "_before", "_part")


def hashed_sample(df: DataFrame, by: list[str], key: str, seed: str, n: int) -> DataFrame:
    """``n`` rows of each group in the order of a digest of key and seed: the same on every engine."""
    w = Window.partitionBy(*by).orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
