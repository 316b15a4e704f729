"""Gradient-boosted depth-two trees over binned features, grown from sums that Spark computes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.binning import binned, quantile_edges, sums_by_bin
from cohortry.llm.common import staged

RATE, RIDGE = 0.5, 1.0


@dataclass
class Tree:
    """A root split and one split on each side: (feature, threshold); four leaf values, low side first."""

    splits: list[tuple[str, float]]
    leaves: list[float]

    def value(self, get: Callable[[str], Column]) -> Column:
        root, low, high = [get(name) > at for name, at in self.splits]
        a, b, c, d = map(F.lit, self.leaves)
        return F.when(root, F.when(high, d).otherwise(c)).otherwise(F.when(low, b).otherwise(a))


def margin(trees: list[Tree], get: Callable[[str], Column]) -> Column:
    total = F.lit(0.0)
    for tree in trees:
        total = total + tree.value(get)
    return total


def probability(trees: list[Tree], get: Callable[[str], Column]) -> Column:
    return 1 / (1 + F.exp(-margin(trees, get)))


def _best(sums: list, edges: dict[str, list[float]]) -> tuple[tuple[str, int], float, float]:
    """The split with the largest gain and the leaf values on its sides; without a gain, all rows stay low."""
    names = list(edges)
    own = {n: {s["bin"]: (s["g"] or 0.0, s["h"] or 0.0) for s in sums if s["feature"] == n} for n in names}
    g_all, h_all = (sum(x[i] for x in own[names[0]].values()) for i in (0, 1))
    best = (0.0, (names[0], len(edges[names[0]])), g_all / (h_all + RIDGE), 0.0)
    for name in names:
        g = h = 0.0
        for cut in range(len(edges[name])):
            x = own[name].get(cut, (0.0, 0.0))
            g, h = g + x[0], h + x[1]
            gain = g * g / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all * g_all / (h_all + RIDGE)
            if gain > best[0] + 1e-9:
                best = (gain, (name, cut), g / (h + RIDGE), (g_all - g) / (h_all - h + RIDGE))
    return best[1:]


def boost(rows: DataFrame, features: list[str], label: str, rounds: int, bins: int = 32) -> list[Tree]:
    """Logistic boosting of ``rounds`` trees on ``rows``; no rows or features without values give no trees.

    Each tree takes two Spark jobs: gradient sums by feature and bin for the root, then the same by side.
    """
    edges = {f: e for f, e in quantile_edges(rows, features, bins).items() if e}
    if not edges:
        return []
    data = staged(binned(rows, edges, [F.col(label).cast("double").alias("_y")]), "boosting")
    at = lambda name, cut: edges[name][cut] if cut < len(edges[name]) else float("inf")
    grown: list[tuple[list[tuple[str, int]], list[float]]] = []
    score = F.lit(0.0)
    for _ in range(rounds):
        p = 1 / (1 + F.exp(-score))
        measures = {"g": F.col("_y") - p, "h": p * (1 - p)}
        root, *_ = _best(sums_by_bin(data, list(edges), measures), edges)
        sides = sums_by_bin(data.withColumn("_side", F.col(root[0]) > root[1]), list(edges), measures, ["_side"])
        low, a, b = _best([s for s in sides if not s["_side"]], edges)
        high, c, d = _best([s for s in sides if s["_side"]], edges)
        grown.append(([root, low, high], [RATE * x for x in (a, b, c, d)]))
        score = score + Tree(*grown[-1]).value(F.col)
    return [Tree([(name, at(name, cut)) for name, cut in splits], leaves) for splits, leaves in grown]
