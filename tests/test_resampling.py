"""Hashed draws and binomial quantiles against exact arithmetic."""

import hashlib
import math
from fractions import Fraction

from cohortry.operators import counting
from pyspark.sql import functions as F


def test_draws_are_digests(spark):
    got = spark.range(3).select("id", counting.hashed_draws(F.col("id"), 21, 7).alias("u")).collect()
    for r in got:
        digests = [hashlib.sha256(f"7:{r.id}:{b}".encode()).hexdigest() for b in range(6)]
        assert r.u == sorted([int(h[13 * i : 13 * i + 13], 16) / 2**52 for h in digests for i in range(4)][:21])


def exact(n, hits, u):
    p, at = Fraction(hits, n), Fraction(0)
    for k in range(n + 1):
        at += math.comb(n, k) * p**k * (1 - p) ** (n - k)
        if at >= u:
            return k
    return n


def test_quantiles_equal_the_exact_distribution(spark):
    rows = [(n, h) for n in (1, 2, 7, 40, 150) for h in sorted({0, 1, n // 3, n // 2, n - 1, n}) if 0 <= h <= n]
    levels = [1e-9, 0.025, 0.3, 0.5, 0.975, 1 - 1e-9]
    df = spark.createDataFrame(rows, "n long, hits long")
    got = df.select("n", "hits", counting.binomial_quantiles(F.col("n"), F.col("hits"), [F.lit(u) for u in levels]).alias("k")).collect()
    for r in got:
        assert r.k == [exact(r.n, r.hits, Fraction(u)) for u in levels], (r.n, r.hits)


def test_quantiles_of_many_draws(spark):
    n, hits = 50_000_000, 40_000_000
    low, high = spark.range(1).select(counting.binomial_quantiles(F.lit(n), F.lit(hits), [F.lit(0.025), F.lit(0.975)]).alias("k")).first().k
    sd = math.sqrt(n * 0.8 * 0.2)
    assert abs(low - (hits - 1.959964 * sd)) < 3 and abs(high - (hits + 1.959964 * sd)) < 3
