"""Half-open intervals: overlap joins, union length, depth and coverage. All start at 0; readers convert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.operators.numbering import dealt
from cohortry.staging import staged


def overlap_bases(s1, e1, s2, e2) -> Column:
    return F.greatest(F.least(e1, e2) - F.greatest(s1, s2), F.lit(0))


#: Each level's bins are so many times as wide as those of the level below; the widest hold all positions. Positions are shifted
#: by SHIFT, so that none is negative.
LEVEL_FACTOR, SHIFT = 8, 1 << 42
#: Left rows of one bin that one task joins, a bin with more is dealt to several; intervals whose depths or ends one task counts.
ROWS_PER_TASK = 1_000_000


def bin_widths(width: int) -> list[int]:
    widths = [width]
    while widths[-1] < 2 * SHIFT:
        widths.append(widths[-1] * LEVEL_FACTOR)
    return widths


def overlap_join(left: DataFrame, right: DataFrame, on: list[str], *, start: str = "start", end: str = "end", right_start: str = "r_start", right_end: str = "r_end", width: int = 2_000, how: str = "inner", small_right: bool = False, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Pairs with equal ``on`` that share a base, or with left_semi the left rows that share one with any right row; equal rows
    count as often as they stand there. Empty intervals share nothing.

    A right interval lies in the one smallest bin that holds it whole, of widths ``width``, 8 ``width``, ...; a left one looks up
    all bins that it touches on the levels that are in use, so a pair meets once, however long either is. Bins with more than
    ``rows_per_task`` left rows are dealt to several tasks, their right rows to each. A semi join carries a number of the left row,
    so that only numbers and positions are exploded. ``small_right`` says that the right side is a fixed table of few rows a key, which
    is then broadcast, and met without bins.
    """
    a, b = left.where(F.col(end) > F.col(start)), right.where(F.col(right_end) > F.col(right_start))
    meet = (F.col(start) < F.col(right_end)) & (F.col(end) > F.col(right_start))
    if small_right:
        few = F.broadcast(b)
        same = reduce(lambda x, y: x & y, [a[c] == b[c] for c in on])
        return a.join(few, same & meet, "left_semi") if how == "left_semi" else a.join(few, on).where(meet)
    widths = bin_widths(width)
    at = lambda position, w: F.floor((position + SHIFT) / F.lit(w)).cast("long")
    level = F.coalesce(*[F.when(at(F.col(right_start), w) == at(F.col(right_end) - 1, w), F.lit(i)) for i, w in enumerate(widths)], F.lit(len(widths) - 1))
    width_of = F.element_at(F.array(*[F.lit(w) for w in widths]), F.col("_level") + 1)
    b = b.withColumn("_level", level).withColumn("_bin", F.floor((F.col(right_start) + SHIFT) / width_of).cast("long"))
    used = sorted(r[0] for r in b.select("_level").distinct().collect())  # at most as many as there are widths
    rows = staged(a.withColumn("_row", F.monotonically_increasing_id()), "rows") if how == "left_semi" else a
    seen = rows.select("_row", *on, start, end) if how == "left_semi" else rows

    def touched(i: int) -> Column:
        """The bins of one level that a left row touches."""
        return F.transform(F.sequence(at(F.col(start), widths[i]), at(F.col(end) - 1, widths[i])), lambda x: F.struct(F.lit(i).alias("_level"), x.alias("_bin")))

    empty = F.array().cast("array<struct<_level:int,_bin:bigint>>")
    seen = seen.withColumn("_b", F.explode(F.concat(empty, *map(touched, used)))).withColumns({"_level": F.col("_b._level"), "_bin": F.col("_b._bin")}).drop("_b")
    key = [*on, "_level", "_bin"]
    hot = staged(seen.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_task).select(*key, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts")), "hot_bins")
    if hot.limit(1).count():  # there are at most as many hot bins as rows over rows_per_task
        deal = F.pmod(F.xxhash64(*(["_row"] if how == "left_semi" else left.columns)), F.coalesce("_salts", F.lit(1))).cast("int")
        seen = seen.join(F.broadcast(hot), key, "left").withColumn("_salt", deal).drop("_salts")
        b = b.join(F.broadcast(hot), key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
        key = [*key, "_salt"]
    met = seen.join(b, key).where(meet)
    if how == "left_semi":
        return rows.join(met.select("_row").distinct(), "_row", "left_semi").drop("_row")
    return met.drop("_level", "_bin", "_salt")


def union_length(df: DataFrame, by: list[str], start: str = "start", end: str = "end", out: str = "union_bases") -> DataFrame:
    """Bases covered by at least one interval of a group: each adds what lies beyond the furthest end before it.

    Intervals of equal start count as the longest of them, before rows are sorted: a group's window holds no more rows than
    its reference has positions, however many reads lie there.
    """
    df = df.groupBy(*by, start).agg(F.max(end).alias(end))
    w = Window.partitionBy(*by).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    furthest = F.coalesce(F.max(end).over(w), F.col(start))
    fresh = df.withColumn("_new", F.greatest(F.col(end) - F.greatest(F.col(start), furthest), F.lit(0)))
    return fresh.groupBy(*by).agg(F.sum("_new").cast("long").alias(out))


def clipped(df: DataFrame, low: int, high: int, start: str = "start", end: str = "end") -> DataFrame:
    """Intervals cut to [low, high); those outside go."""
    cut = df.withColumn(start, F.greatest(F.col(start), F.lit(low))).withColumn(end, F.least(F.col(end), F.lit(high)))
    return cut.where(F.col(end) > F.col(start))


def supporting(df: DataFrame, by: list[str], part: str, floor: int, low: int, high: int) -> DataFrame:
    """Groups' parts (contigs) whose clipped union reaches ``floor`` bases: their number and total."""
    united = union_length(clipped(df, low, high), [*by, part])
    return united.where(F.col("union_bases") >= floor).groupBy(*by).agg(F.count(F.lit(1)).alias("parts"), F.sum("union_bases").cast("long").alias("bases"))


def depth_segments(df: DataFrame, by: list[str], start: str = "start", end: str = "end", *, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Runs of equal depth: seg_start, seg_end, depth, by a sweep over starts and ends. Depth 0 is not listed.

    Intervals are dealt out by group and start, ``rows_per_task`` to a task, before a task counts the starts and ends at each position."""
    events = dealt(df.select(*by, start, end), [*by, start], rows_per_task).select(*by, F.explode(F.array(F.struct(F.col(start).alias("pos"), F.lit(1).alias("step")), F.struct(F.col(end).alias("pos"), F.lit(-1).alias("step")))).alias("e"))
    steps = events.groupBy(*by, "e.pos").agg(F.sum("e.step").alias("step"))
    w = Window.partitionBy(*by).orderBy("pos")
    swept = steps.select(*by, F.col("pos").alias("seg_start"), F.lead("pos").over(w).alias("seg_end"), F.sum("step").over(w).cast("long").alias("depth"))
    return swept.where((F.col("depth") > 0) & F.col("seg_end").isNotNull())


def breadth(segments: DataFrame, by: list[str], length: int, levels: list[int]) -> DataFrame:
    """Share of ``length`` bases at each depth or more."""
    size = F.col("seg_end") - F.col("seg_start")
    return segments.groupBy(*by).agg(*[(F.sum(F.when(F.col("depth") >= k, size).otherwise(0)) / length).alias(f"breadth_{k}x") for k in levels])


#: Neighbouring bins whose sums one row holds side by side.
BINS_PER_ROW = 16


def binned_depth(segments: DataFrame, by: list[str], width: int, *, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Summed depth of each bin that has any. Segments may overlap: intervals of depth 1 do as well as the runs of a sweep.

    Segments are dealt out by group and start, ``rows_per_task`` to a task, and summed there before the sums are shuffled: so a task
    holds the bins of its own stretch of groups, and a group of any depth lies on several tasks. Sums are kept in a row for
    each ``BINS_PER_ROW`` bins; a segment is copied only to each such block of bins that it touches.
    """
    reach, depth = width * BINS_PER_ROW, F.col("depth")
    block = F.sequence(F.floor(F.col("seg_start") / reach), F.floor((F.col("seg_end") - 1) / reach))
    some = segments.where(F.col("seg_end") > F.col("seg_start")).select(*by, "seg_start", "seg_end", "depth")
    cut = dealt(some, [*by, "seg_start"], rows_per_task).withColumn("_block", F.explode(block))
    low = [F.col("_block") * reach + i * width for i in range(BINS_PER_ROW)]
    sums = cut.groupBy(*by, "_block").agg(*[F.sum(overlap_bases(F.col("seg_start"), F.col("seg_end"), x, x + width) * depth).cast("long").alias(f"_{i}") for i, x in enumerate(low)])
    each = F.explode(F.array(*[F.struct((F.col("_block") * BINS_PER_ROW + i).alias("bin"), F.col(f"_{i}").alias("depth_sum")) for i in range(BINS_PER_ROW)]))
    return sums.select(*by, each.alias("_b")).select(*by, "_b.bin", "_b.depth_sum").where(F.col("depth_sum") > 0)


def weighted_depth(segments: DataFrame, by: list[str], low: int, high: int) -> DataFrame:
    """Mean depth of a region over the bases that segments cover there, weighted by bases."""
    size = overlap_bases(F.col("seg_start"), F.col("seg_end"), F.lit(low), F.lit(high))
    return segments.where(size > 0).groupBy(*by).agg((F.sum(size * F.col("depth")) / F.sum(size)).alias("weighted_depth"))


def near(features: DataFrame, anchors: DataFrame, on: list[str], reach: int, *, start: str = "start", end: str = "end", anchor_start: str = "r_start", anchor_end: str = "r_end") -> DataFrame:
    """Features within ``reach`` bases of an anchor with equal ``on``, each row once."""
    wide = anchors.select(*on, (F.col(anchor_start) - reach).alias("r_start"), (F.col(anchor_end) + reach).alias("r_end"))
    return overlap_join(features, wide, on, start=start, end=end, width=max(2_000, reach), how="left_semi")


def first_overlap(left: DataFrame, right: DataFrame, on: list[str], key: str, order: str, *, small_right: bool = False) -> DataFrame:
    """For each ``key`` of the left side, the overlapping right row of least ``order``."""
    return overlap_join(left, right, on, small_right=small_right).groupBy(key).agg(F.min(order).alias(order))
