"""Models that are fitted on all documents, not on a sample of them."""

from pyspark.sql import functions as F

from cohortry.llm import pii


def test_the_selector_sees_the_candidates_of_all_documents(spark, monkeypatch):
    """One candidate a document, in more documents than any fixed sample held: trees and thresholds take all of them."""
    n = 24_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("write to ann@mail.example.org soon").alias("text"))
    seen, real = {}, pii.staged

    def kept(df, name):
        seen[name] = real(df, name)
        return seen[name]

    monkeypatch.setattr(pii, "staged", kept)
    monkeypatch.setattr(pii, "boost", lambda rows, *_: seen.update(fitted=rows.count()) or [])
    pii.fit_selector(docs)
    held_out = docs.where(F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id")), F.lit(3)) == 2).count()
    assert seen["candidates"].count() == n
    assert seen["fitted"] == n - held_out
