"""Quality rules from few labels: what is accepted, and what a list that learned nothing says."""

import random

import pytest
from cohortry.llm import quality_rules


def test_lower_bounds_grow_with_the_rows():
    assert quality_rules.surely(0, 0) == 0.0 and quality_rules.surely(6, 6) < quality_rules.MIN_SURE <= quality_rules.surely(7, 7)
    assert quality_rules.surely(9, 10) < quality_rules.surely(90, 100) < quality_rules.surely(900, 1000) < 0.9
    p, n, z = 0.8, 50, 1.645
    low = quality_rules.surely(40, 50)
    assert abs((p - low) - z * (low * (1 - low) / n) ** 0.5) < 1e-9  # the end of the interval, by its definition


def texts(rng, n, bad):
    letters = "abcdefgh#%&$" if bad else "abcdefgh"
    return [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(40)) for _ in range(n)]


@pytest.mark.parametrize("n_bad, learned", [(60, True), (2, False)])
def test_rules_of_few_labels(spark, n_bad, learned):
    rng = random.Random(3)
    rows = [(i, t, int(i >= n_bad)) for i, t in enumerate(texts(rng, n_bad, True) + texts(rng, 150, False))]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 0), (950, None)], "doc_id long, quality int")
    rules = quality_rules.fitted_rules(docs, labels)
    assert bool(rules) is learned
    kept = {r.doc_id for r in quality_rules.quality_rules(docs, rules).where("kept").collect()}
    assert kept == {i for i, _, q in rows if q or not learned}
    assert all(r.precision >= quality_rules.MIN_PRECISION and r.covered < 40 for r in rules)
