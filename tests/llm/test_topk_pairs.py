"""How op11's tiles and blocks of queries meet: nothing is broadcast, and narrow matrices hold what wide ones would."""

import numpy as np
from pyspark.sql import functions as F

from cohortry.llm import topk_search as topk


def test_no_side_of_the_pairs_is_broadcast(spark, monkeypatch):
    """A side that seems small is not sent through the driver: what it would hold grows with queries times vectors."""
    monkeypatch.setattr(topk, "TILE", 4)
    monkeypatch.setattr(topk, "BLOCK", 2)
    df = spark.range(400).select(F.col("id").alias("vec_id"), F.array(F.sin("id"), F.cos("id")).alias("embedding"))
    got = topk.topk_search(df, F.col("vec_id") % 10 == 0, k=3)
    assert len(got.collect()) == 40 * 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan
    assert "Broadcast" not in plan


def test_pairs_are_read_not_copied(spark, monkeypatch):
    """What is staged grows with the vectors, not with tiles times blocks."""
    monkeypatch.setattr(topk, "TILE", 4)
    monkeypatch.setattr(topk, "BLOCK", 2)
    kept, real = {}, topk.staged
    monkeypatch.setattr(topk, "staged", lambda df, name: kept.setdefault(name, real(df, name)))
    df = spark.range(400).select(F.col("id").alias("vec_id"), F.array(F.sin("id"), F.cos("id")).alias("embedding"))
    assert topk.topk_search(df, F.col("vec_id") % 10 == 0, k=3).count() == 40 * 3
    vectors = F.sum(F.octet_length("uids") / 8).cast("int")
    assert [kept[name].agg(vectors).first()[0] for name in ("tiles", "blocks")] == [400, 40]


def test_numbers_of_all_widths_in_one_table(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE", 8)
    monkeypatch.setattr(topk, "BLOCK", 2)
    rng = np.random.default_rng(9)
    whole = rng.integers(-900, 900, (60, 5)) * np.repeat([1, 1 << 11, 1 << 20], 20)[:, None]  # 16, 32 and more bits
    df = spark.createDataFrame([(i, [float(x) / 1024 for x in v]) for i, v in enumerate(whole)], "vec_id long, embedding array<double>").orderBy("vec_id")
    got = topk.topk_search(df, F.col("vec_id") % 5 == 0, k=7).collect()
    scores = whole @ whole.T
    want = [(q, r, c, int(scores[q, c])) for q in range(0, 60, 5) for r, c in enumerate(sorted(set(range(60)) - {q}, key=lambda c: (-scores[q, c], c))[:7], 1)]
    assert sorted(map(tuple, got)) == sorted(want)
