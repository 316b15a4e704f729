"""The similarity join against brute force, with hot groups, and the pipeline's choice of one of each group."""

import random
import re
from itertools import combinations

import pytest
from cohortry.llm import jaccard_join
from cohortry.llm.components import components
from pyspark.sql import functions as F


def brute(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            group[find(a)] = find(b)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return sorted((k, len(sets[i]), least[find(i)]) for i, (k, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", "a", "A", "a b", "a b c d", "a b c d", "one two three four five six seven eight nine ten"]
    for _ in range(6):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([8, 30, 60, 150]))]
        for _ in range(rng.choice([2, 5, 30])):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 20)):
                copy[rng.randrange(len(copy))] = f"v{rng.randrange(50)}"
            texts.append(" ".join(copy))
    texts += ["the same head of lines " + " ".join(f"u{rng.randrange(10_000)}" for _ in range(9)) for _ in range(30)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,star", [(1, 16), (2, 3)])
def test_components_equal_brute_force(spark, monkeypatch, seed, star):
    monkeypatch.setattr(jaccard_join, "STAR", star)
    rows = corpus(seed)
    got = jaccard_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows)


def hot_corpus(seed, many):
    """One group of edited copies, two templates with bodies in common, and a head line before other text."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"
    base, heads = [word() for _ in range(70)], [[word() for _ in range(60)] for _ in range(2)]
    bodies = [[word() for _ in range(rng.randrange(3, 12))] for _ in range(many // 6)]
    texts = []
    for _ in range(many):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4])):
            at = rng.randrange(len(copy))
            copy[at : at + 1] = rng.choice([[], [word()], ["v1"], [copy[at], "v2"]])
        texts.append(" ".join(copy))
    for i in range(many):
        texts.append(" ".join(heads[i % 2] + bodies[rng.randrange(len(bodies))] + [word()] * (i % 3 == 0)))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,merged", [(3, 1), (4, 0)])
def test_hot_groups_equal_brute_force(spark, monkeypatch, seed, merged):
    monkeypatch.setattr(jaccard_join, "STAR", 6)
    monkeypatch.setattr(jaccard_join, "ASKERS", 5)
    monkeypatch.setattr(jaccard_join, "MERGED_ROUNDS", merged)
    rows = hot_corpus(seed, 150)
    got = jaccard_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows)


def test_pairs_of_a_hot_group_stay_linear(spark):
    """Documents of which each pair is close to a link: no pair but the linked ones is compared."""
    rng = random.Random(9)
    base, n = [f"w{i}" for i in range(100)], 300
    cut = [[w if i not in gone else f"v{k}-{i}" for i, w in enumerate(base)] for k in range(n) for gone in [set(rng.sample(range(100), 2))]]
    sets = spark.createDataFrame([((k, 0), [hash(tuple(w[i : i + 4])) for i in range(97)]) for k, w in enumerate(cut)], "node struct<a: long, b: long>, shingles array<long>")
    lists = sets.select(F.lit(1).cast("bigint").alias("key"), "node", F.size("shingles").alias("n"))
    _, pairs = jaccard_join.long_lists(lists, sets, 85)
    assert pairs.count() < 10 * n


def test_one_of_each_keeps_columns_of_any_name(spark):
    names = ["doc_id", "text", "stays", "_id", "_mark", "_words", "_node", "node", "id", "row", "words"]
    df = spark.createDataFrame([(i, "a b c d e" if i < 3 else f"x{i} y z q") + ("p",) * 9 for i in range(5)], names)
    kept = jaccard_join.one_of_each(df)
    assert kept.columns == names and sorted(r.doc_id for r in kept.collect()) == [0, 3, 4] and all(r[2:] == ("p",) * 9 for r in kept.collect())
    assert jaccard_join.one_of_each(df.where("doc_id < 0")).count() == 0 and jaccard_join.jaccard_groups(df.where("doc_id < 0")).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (3, "x y z q"), (3, "x y z q"), (4, None), (5, ""), (None, "p q r s"), (None, "p q r s")]
    kept = jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(kept.collect(), key=repr) == sorted([(1, "a b c d e"), (3, "x y z q"), (4, None), (5, ""), (None, "p q r s")], key=repr)


def test_components_of_a_chain_and_an_empty_table(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101), (100, 100), (None, 5)], "left long, right long")
    got = {r.node: r.component for r in components(chain, "left", "right").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(chain.where("left < -1"), "left", "right").count() == 0
