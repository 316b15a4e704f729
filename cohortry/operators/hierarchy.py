"""Parent-child trees: ancestors, the nearest marked one, places in depth-first order, and chains of records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.operators.numbering import numbered
from cohortry.operators.skew import lookup
from cohortry.staging import small, staged


def ancestors(tree: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """node, ancestor, distance for each ancestor, the node itself at 0. Roots point at themselves or at null.

    Each round doubles the length of the known paths, is staged, and is the last one if it found no new pair; so depth d
    takes log2(d) + 1 rounds, whatever d is. On a cycle each node is an ancestor of the others and not of itself.
    """
    step = tree.select(F.col(node).alias("node"), F.when(F.col(node) != F.col(parent), F.col(parent)).alias("ancestor")).where("ancestor is not null")
    closure = staged(step.distinct().withColumn("distance", F.lit(1)), "closure")
    known = closure.count()
    while True:
        far = closure.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("_a"), F.col("distance").alias("_d"))
        longer = closure.join(far, "ancestor").select("node", F.col("_a").alias("ancestor"), (F.col("distance") + F.col("_d")).alias("distance")).where("node <> ancestor")
        closure = staged(closure.union(longer).groupBy("node", "ancestor").agg(F.min("distance").alias("distance")), "closure")
        found = closure.count()
        if found == known:
            break
        known = found
    own = tree.select(F.col(node).alias("node"), F.col(node).alias("ancestor"), F.lit(0).alias("distance")).distinct()
    return own.union(closure)


def rank_ancestor(closure: DataFrame, ranks: DataFrame, rank: str) -> DataFrame:
    """For each node the nearest ancestor of a rank (itself included); nodes without one are not listed."""
    of_rank = ranks.where(F.col("rank") == rank).select(F.col("node").alias("ancestor"))
    return closure.join(of_rank, "ancestor").groupBy("node").agg(F.min(F.struct("distance", "ancestor")).alias("_m")).select("node", F.col("_m.ancestor").alias("found"))


def below(closure: DataFrame, root) -> DataFrame:
    """The nodes under a root, itself included."""
    return closure.where(F.col("ancestor") == root).select("node").distinct()


def nearest_marked(tree: DataFrame, marks: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """For each node the nearest of itself and its ancestors that ``marks`` (node) lists: node, found; null if none is.

    By pointer jumping, with one row a node: after round k a row knows the nearest mark among 2^k ancestors and the ancestor
    2^k above. A row that has found its mark, or has no ancestor left, is done; so there are as many rounds as the depth has
    binary digits, and no table of nodes and ancestors. Roots point at themselves or at null. Nodes of a cycle are done once
    they have jumped over all nodes. A parent that is no node is none.
    """
    marked = marks.select(F.col(marks.columns[0]).alias("node")).distinct().withColumn("found", F.col("node"))
    step = tree.select(F.col(node).alias("node"), F.when(F.col(node) != F.col(parent), F.col(parent)).alias("up")).groupBy("node").agg(F.min("up").alias("up"))
    state = step.join(marked, "node", "left").select("node", F.when(F.col("found").isNull(), F.col("up")).alias("up"), "found")
    state, reach, fits, total = staged(state, "marks"), 1, None, 0
    while (n := state.agg(F.count("up"), F.count(F.lit(1))).first())[0]:
        if fits is None:
            fits, total = small(state), n[1]
        if reach > 2 * total:
            break
        open_rows = state.where("up IS NOT NULL")
        above = state.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("found").alias("seen"))
        if fits:
            met = open_rows.join(F.broadcast(above), "up", "left")
        else:  # one ancestor may be that of most nodes
            met = lookup(open_rows, open_rows.groupBy("up").agg(F.count(F.lit(1)).alias("below")).join(above, "up", "left"), ["up"], "below", n[0], how="left")
        moved = met.select("node", F.when(F.col("seen").isNull(), F.col("next")).alias("up"), F.col("seen").alias("found"))
        state, reach = staged(state.where("up IS NULL").unionByName(moved), "marks"), 2 * reach
    return state.select("node", "found")


def tour(df: DataFrame, group: list[str], node: str, parent: str, order: list[str]) -> DataFrame:
    """Places of all nodes of all groups' forests at once: ``group``, ``node``, ``enter`` and ``leave``, both from 0.

    ``enter`` is the place in depth-first order, siblings and roots by ``order``; ``leave`` is one more than the last place
    below the node, so b is below a if and only if a.enter < b.enter < a.leave. A parent that is not a node of the group makes
    a root. A group without any root has its first node as one. Nodes that no root reaches have null places.

    The tour goes down and up every edge; it is a list, ranked by recursive doubling: each round every element adds what its
    successor has and jumps to where that one points. Rounds grow with the logarithm of the longest list, whatever the number of groups.
    Tables of nodes are joined by shuffle: by the size of their files, which compress well, Spark would send them all to the driver
    and broadcast them in each round.
    """
    at = [F.col(c) for c in order]
    rows = staged(df.select(*group, F.col(node).alias("_v"), F.col(parent).alias("_p"), F.struct(*at).alias("_o")), "forest")
    nodes = rows.select(*group, F.col("_v").alias("_p")).distinct().withColumn("_known", F.lit(True))
    rooted = rows.join(nodes.hint("merge"), [*group, "_p"], "left").select(*group, "_v", F.when(F.col("_known"), F.col("_p")).alias("_p"), "_o")
    # a group of cycles alone begins at its first node
    first = rooted.groupBy(*group).agg(F.count_if(F.col("_p").isNull()).alias("_roots"), F.min_by("_v", "_o").alias("_first"))
    rooted = rooted.join(first, group).withColumn("_p", F.when((F.col("_roots") == 0) & (F.col("_v") == F.col("_first")), None).otherwise(F.col("_p")))
    placed = staged(numbered(rooted.select(*group, "_v", "_p", "_o"), ["_o"], by=[*group, "_p"], name="_i"), "placed")
    right = placed.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_p").alias("_q"), (F.col("_i") - 1).alias("_j"), F.col("_v").alias("_right"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)], F.col("_p").eqNullSafe(F.col("_q")) & (F.col("_i") == F.col("_j")))
    rooted = staged(placed.join(right.hint("merge"), same, "left").select(*group, "_v", "_p", "_right", "_i"), "siblings")
    child = rooted.where("_i = 1 AND _p IS NOT NULL").select(*group, F.col("_p").alias("_v"), F.col("_v").alias("_child"))
    element = lambda v, up: F.struct(F.col(v).alias("v"), F.lit(up).alias("up"))
    down = F.struct(element("_v", False).alias("e"), F.when(F.col("_child").isNotNull(), element("_child", False)).otherwise(element("_v", True)).alias("next"), F.lit(1).cast("long").alias("n"))
    back = F.when(F.col("_right").isNotNull(), element("_right", False)).when(F.col("_p").isNotNull(), element("_p", True))
    up = F.struct(element("_v", True).alias("e"), back.alias("next"), F.lit(0).cast("long").alias("n"))
    state = staged(rooted.join(child.hint("merge"), [*group, "_v"], "left").select(*group, F.explode(F.array(down, up)).alias("x")).select(*group, "x.*"), "tour")
    limit, reach = 2 * state.count(), 1
    while reach <= limit and state.where("next IS NOT NULL").limit(1).count():
        ahead = state.select(*group, F.col("e").alias("next"), F.col("n").alias("_n"), F.col("next").alias("_next"))
        moved = state.where("next IS NOT NULL").join(ahead.hint("merge"), [*group, "next"]).select(*group, "e", F.col("_next").alias("next"), (F.col("n") + F.col("_n")).alias("n"))
        state, reach = staged(state.where("next IS NULL").unionByName(moved), "tour"), 2 * reach
    # what is left to the end of the list: all nodes of the group's tour less those before
    found = state.where("next IS NULL")
    ranks = found.groupBy(*group, F.col("e.v").alias(node)).agg(F.max(F.when(~F.col("e.up"), F.col("n"))).alias("_a"), F.max(F.when(F.col("e.up"), F.col("n"))).alias("_b"))
    total = found.groupBy(*group).agg(F.max("n").alias("_all"))
    placed = ranks.join(total, group).select(*group, node, (F.col("_all") - F.col("_a")).alias("enter"), (F.col("_all") - F.col("_b")).alias("leave"))
    return rows.select(*group, F.col("_v").alias(node)).join(placed.hint("merge"), [*group, node], "left")


def chain_order(df: DataFrame, file: str, node: str, previous: str, ordinal: str) -> DataFrame:
    """Program records of each file along their links: place of each, roots first, each before those that follow it, and
    records that no root reaches at the end, in input order. All files are ordered at once, by ``tour``; of records with one name the
    first counts."""
    once = df.groupBy(file, node).agg(F.min_by(previous, ordinal).alias(previous), F.min(ordinal).alias(ordinal))
    once = staged(once, "records")
    placed = tour(once, [file], node, previous, [ordinal]).select(file, node, "enter").join(once.select(file, node, ordinal).hint("merge"), [file, node])
    in_file = numbered(placed, [F.col("enter").asc_nulls_last(), ordinal], by=[file], name="place")
    return in_file.select(file, node, (F.col("place") - 1).alias("place"))
