"""Counts, pivots and consolidations. A group that was measured and found nothing has 0; one not measured has null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.operators.numbering import running
from cohortry.operators.skew import lookup
from cohortry.staging import staged


def zero_filled(counts: DataFrame, dimension: DataFrame, on: list[str], value: str) -> DataFrame:
    """A row for each row of the dimension, 0 where there is no count. The dimension is small and goes to the counts' groups."""
    return dimension.join(counts, on, "left").withColumn(value, F.coalesce(F.col(value), F.lit(0).cast("long")))


def four_countings(df: DataFrame, by: list[str], fragment: str, duplicate: str) -> DataFrame:
    """Reads, unmarked reads, distinct fragments, and distinct fragments among unmarked reads."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("raw"), F.count_if(~F.col(duplicate)).alias("dup_marked"), F.countDistinct(fragment).alias("fragment"),
        F.countDistinct(F.when(~F.col(duplicate), F.col(fragment))).alias("dup_collapsed"),
    )


def position_duplicates(df: DataFrame, by: list[str], key: list[str]) -> DataFrame:
    """Records less distinct positions of each group."""
    distinct = df.groupBy(*by, *key).agg(F.count(F.lit(1)).alias("_n")).groupBy(*by).agg(F.sum("_n").cast("long").alias("records"), F.count(F.lit(1)).alias("positions"))
    return distinct.withColumn("duplicates", F.col("records") - F.col("positions"))


def pivoted(df: DataFrame, row: list[str], column: str, names: list, value: str) -> DataFrame:
    """A wide table with a column for each of ``names``; 0 where there is no row."""
    return df.groupBy(*row).pivot(column, names).agg(F.sum(value).cast("long")).na.fill(0, [str(n) for n in names])


def eav_wide(df: DataFrame, key: list[str], metric: str, value: str, metrics: list[str]) -> tuple[DataFrame, DataFrame]:
    """(wide, conflicts): a metric given twice with one value is one; with different values it is a conflict and null."""
    each = df.groupBy(*key, metric).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count(F.lit(1)).alias("rows"))
    wide = each.groupBy(*key).agg(*[F.max(F.when((F.col(metric) == m) & (F.col("low") == F.col("high")), F.col("low"))).alias(m) for m in metrics])
    return wide, each.where(F.col("low") != F.col("high"))


#: Distinct values of a group that one task may hold to pick its order statistics; of groups with more, no task holds the values.
BUFFERED = 100_000


def at_ranks(counts: DataFrame, by: list[str], value: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """For each group the values at some places of its sorted values, from 0; ``ranks`` take the group's n and give the place.
    ``counts`` have by, value and ``_c``, how often the value occurs.

    Values are dealt out by range and their counts summed along it (``numbering.running``); the value at a place is the one whose
    running count passes it. All groups and places are found in one pass, and a group of any size lies on all tasks.
    """
    counts = staged(counts, "counts")
    sizes = counts.groupBy(*by).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_values"))
    placed = staged(running(counts, by, [value], {"_upto": F.col("_c")}), "placed")
    met = lookup(placed, sizes, by, "_values", counts.count())
    here = lambda r: (F.col("_upto") > r) & (F.col("_upto") - F.col("_c") <= r)
    return met.groupBy(*by).agg(*[F.max(F.when(here(r(F.col("_n"))), F.col(value))).alias(name) for name, r in ranks.items()], F.first("_n").alias("_n"))


def _counted(df: DataFrame, by: list[str], value: str) -> tuple[DataFrame, bool]:
    """How often each value occurs in each group, and whether the distinct values of every group are few."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    most = counts.groupBy(*by).agg(F.count(F.lit(1)).alias("_v")).agg(F.max("_v")).first()[0]
    return counts, (most or 0) <= BUFFERED


def quantiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Interpolated quantiles (type 7) of each group by name, exact on whole numbers and doubles; nulls do not count and a group of
    nulls alone is not listed."""
    counts, few = _counted(df, by, value)
    if few:
        q = F.percentile(value, F.array(*map(F.lit, shares.values())), F.col("_c"))
        return counts.groupBy(*by).agg(q.alias("_q")).select(*by, *[F.col("_q")[i].alias(name) for i, name in enumerate(shares)])
    ends = {}
    for name, q in shares.items():
        ends[f"_lo_{name}"] = lambda n, q=q: F.floor(F.lit(q) * (n - 1))
        ends[f"_hi_{name}"] = lambda n, q=q: F.ceil(F.lit(q) * (n - 1))
    found = at_ranks(counts, by, value, ends)
    between = lambda name, q: F.lit(q) * (F.col("_n") - 1) - F.floor(F.lit(q) * (F.col("_n") - 1))
    mixed = lambda name, q: (1 - between(name, q)) * F.col(f"_lo_{name}") + between(name, q) * F.col(f"_hi_{name}")
    return found.select(*by, *[mixed(name, q).cast("double").alias(name) for name, q in shares.items()])


def five_numbers(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Minimum, interpolated quartiles (type 7) and maximum."""
    ends = df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"))
    return ends.join(quantiles(df, by, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}), by).select(*by, "low", "q1", "median", "q3", "high")


def nearest_rank(df: DataFrame, by: list[str], value: str, q: float) -> DataFrame:
    """The value at place floor(q (n - 1)) of the sorted values: a truncating quantile, exact and without interpolation."""
    counts, few = _counted(df, by, value)
    place = lambda n: F.floor(F.lit(q) * (n - 1))
    if not few:
        return at_ranks(counts, by, value, {"quantile": place}).select(*by, "quantile")
    w = Window.partitionBy(*by)
    placed = counts.withColumns({"_upto": F.sum("_c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)), "_n": F.sum("_c").over(w)})
    at = place(F.col("_n"))
    return placed.where((F.col("_upto") > at) & (F.col("_upto") - F.col("_c") <= at)).select(*by, F.col(value).alias("quantile"))


def summary_numbers(df: DataFrame, by: list[str], value: str, q: float) -> DataFrame:
    """Least, mean, interpolated median, truncating quantile and greatest value of each group; nulls do not count."""
    plain = df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.min(value).alias("low"), F.avg(value).alias("mean"), F.max(value).alias("high"))
    found = plain.join(quantiles(df, by, value, {"median": 0.5}), by).join(nearest_rank(df, by, value, q), by)
    return found.select(*by, "low", "mean", "median", "high", "quantile")


def share(part: Column, whole: Column) -> Column:
    """part / whole; null if either is null or the whole is 0."""
    return F.try_divide(part.cast("double"), F.nullif(whole.cast("double"), F.lit(0.0)))


def hashed_draws(key: Column, rounds: int, seed: int) -> Column:
    """``rounds`` uniform numbers from [0, 1), ascending: draws 4 b to 4 b + 3 are the four 52-bit pieces at the head of the SHA-256
    of seed, key and b. They depend on nothing else, so any engine that hashes draws the same ones."""
    digest = lambda b: F.sha2(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), b.cast("string")).cast("binary"), 256)
    digests = F.transform(F.sequence(F.lit(0), F.lit((rounds - 1) // 4)), digest)
    bits = lambda h, i: F.conv(F.substring(h, 13 * i + 1, 13), 16, 10).cast("double") / float(1 << 52)
    drawn = F.flatten(F.transform(digests, lambda h: F.array(*[bits(h, i) for i in range(4)])))
    return F.sort_array(F.slice(drawn, 1, rounds))  # not array_sort, whose comparator is interpreted


#: Standard deviations, and hits besides, on either side of the mode that a binomial distribution is summed over. What lies
#: outside is less than the last bit of a double.
BINOMIAL_REACH, BINOMIAL_LEAST = 10, 20


def binomial_quantiles(n: Column, hits: Column, levels: list[Column]) -> Column:
    """For each level u the least k for which the chance of at most k hits in n draws, each a hit with chance hits / n, is u
    or more: an array of longs. Weights grow from the lower end by their ratios, so no factorial and no logarithm is taken,
    and steps are in proportion to the square root of n. n is 1 or more."""
    n, hits = n.cast("double"), hits.cast("double")
    reach = F.ceil(F.sqrt(hits * (n - hits) / n) * BINOMIAL_REACH) + BINOMIAL_LEAST
    low, high = F.greatest(hits - reach, F.lit(0.0)).cast("long"), F.least(hits + reach, n).cast("long")
    odds = hits / (n - hits)
    # the weight of k + 1 from that of k
    grown = lambda w, k: w * ((n - k) / (k + 1) * odds)
    steps = F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(steps, F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("t")), lambda s, k: F.struct(grown(s["w"], k).alias("w"), (s["t"] + grown(s["w"], k)).alias("t")))["t"]

    def at(u: Column) -> Column:
        goal = u * total  # held in the state: a lambda would sum it up again at every step
        start = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("t"), F.when(F.lit(1.0) >= goal, low).alias("k"), goal.alias("goal"))

        def step(s: Column, k: Column) -> Column:
            w = grown(s["w"], k)
            return F.struct(w.alias("w"), (s["t"] + w).alias("t"), F.coalesce(s["k"], F.when(s["t"] + w >= s["goal"], k + 1)).alias("k"), s["goal"].alias("goal"))

        return F.coalesce(F.aggregate(steps, start, step)["k"], high)

    sure = F.when(hits == 0, F.lit(0)).when(hits == n, n.cast("long"))
    return F.array(*[F.coalesce(sure.cast("long"), at(u)) for u in levels])


def bootstrap_share(df: DataFrame, by: list[str], order: str, outcome: str, *, seed: int = 1, rounds: int = 1000) -> DataFrame:
    """95 % percentile interval of the share of true outcomes, resampled ``rounds`` times: by, low, high.

    The hits among n draws with replacement from n outcomes are binomial, so only each group's n and hits matter. A round is
    one uniform number (``hashed_draws`` of the group's key) put through the inverse of that distribution; as the inverse
    does not fall, the bounds are the inverses of the 25th and 975th of 1000 sorted numbers, and two suffice. Null outcomes are
    not measured and not drawn; without measured ones both bounds are null. No group's rows meet in a task, and ``order``, the
    order in which outcomes would be drawn from, does not matter.
    """
    counts = df.groupBy(*by).agg(F.count(outcome).alias("_n"), F.count_if(outcome).alias("_hits"))
    key = F.concat_ws("/", *[F.col(c).cast("string") for c in by])
    some = counts.withColumn("_u", F.when(F.col("_n") > 0, hashed_draws(key, rounds, seed)))
    levels = [F.get("_u", F.lit(int(0.025 * rounds))), F.get("_u", F.lit(min(rounds - 1, int(0.975 * rounds))))]
    some = some.withColumn("_k", F.when(F.col("_n") > 0, binomial_quantiles(F.col("_n"), F.col("_hits"), levels)))
    return some.select(*by, *[(F.col("_k")[i] / F.col("_n")).alias(name) for i, name in enumerate(("low", "high"))])
