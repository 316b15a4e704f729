"""Quantile bins of numeric features and label sums by bin, for models that are grown from such statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quantile_edges(df: DataFrame, features: list[str], bins: int) -> dict[str, list[float]]:
    """Up to ``bins`` distinct quantiles of each feature; a feature without values has none."""
    at = [i / bins for i in range(bins + 1)]
    row = df.agg(*[F.percentile_approx(f, at, 10_000).alias(f) for f in features]).first()
    return {f: sorted({float(x) for x in row[f] or []}) for f in features}


def bin_of(feature: str, edges: list[float]) -> Column:
    """How many edges are less than the value: 0 to len(edges). Null counts as 0."""
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col(feature))), F.lit(0)) if edges else F.lit(0)


def binned(df: DataFrame, edges: dict[str, list[float]], keep: list[str]) -> DataFrame:
    """``keep`` and, for each feature, its bin under the feature's name."""
    return df.select(*keep, *[bin_of(f, e).cast("int").alias(f) for f, e in edges.items()])


def sums_by_bin(df: DataFrame, features: list[str], measures: dict[str, Column], by: list[str] = []) -> list:  # noqa: B006
    """For each feature and bin (and ``by``) the sums of the measures; as many rows as there are bins, whatever the input."""
    made = df.select(*by, *[m.alias(k) for k, m in measures.items()], F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in features])).alias("_x"))
    return made.groupBy(*by, "_x.feature", "_x.bin").agg(*[F.sum(k).alias(k) for k in measures]).collect()
