"""Top-k search, spelling variants and the conversation trie against brute force on small tables, with nulls, ties, repeats,
empty and very long values, and clashing column names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.llm import conversation_trie as trie
from cohortry.llm import spelling_variants as spelling
from cohortry.llm import topk_search as topk

# --- top-k search


def best_by_hand(rows, asks, k):
    whole = []
    for i, (vec_id, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, vec_id, [math.floor(1024 * x) for x in v]))
    out = []
    for i, vec_id, v in whole:
        if asks(vec_id):
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), other is None, other or 0) for j, other, w in whole if j != i)[:k]
            out += [(vec_id, r, None if null else other, -s) for r, (s, null, other) in enumerate(scored, 1)]
    return sorted(out, key=repr)


def test_topk_equals_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(topk, "TILE", 16)
    monkeypatch.setattr(topk, "BLOCK", 3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(20)]) for i in range(120)]
    rows += [(i, [0.5] * 20) for i in range(120, 140)]  # ties
    rows += [(10, rows[10][1]), (10, rows[11][1]), (None, [0.5] * 20), (300, None), (310, [float("nan")] * 20), (320, [1.0, None]), (330, [float("inf")]), (340, []), (350, [2.0, -3.0])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, rank string")
    got = topk.topk_search(df, F.col("vec_id") % 10 == 0, k=4)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == best_by_hand(rows, lambda i: i is not None and i % 10 == 0, 4)
    assert topk.topk_search(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert topk.topk_search(df, F.lit(False)).count() == 0


def test_topk_beyond_exact_doubles(spark):
    rows = [(0, [1e6, 1.0]), (1, [1e6, 2.0]), (2, [1e6, 3.0]), (3, [1e12, 1.0]), (4, [1e12, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.topk_search(df, F.col("vec_id") == 0).orderBy("rank").collect()
    exact = [(2, (1024 * 10**6) ** 2 + 3 * 1024**2), (1, (1024 * 10**6) ** 2 + 2 * 1024**2)]
    # scores beyond a long are the nearest long, and tie
    assert [(r.vec_id, r.score) for r in got] == [(3, 2**63 - 1), (4, 2**63 - 1), *exact]


def test_bounds_keep_every_pair_that_may_count():
    rng = np.random.default_rng(5)
    for _ in range(20):
        queries, tile = rng.integers(-900, 900, (40, 7)), rng.integers(-900, 900, (40, 300))
        tile[:, 50:60] = tile[:, :1]  # ties
        own = rng.random((7, 300)) < 0.01
        scores = np.where(own, -(1 << 60), queries.T @ tile)
        q, t, found = topk.best_in_tile(queries, tile, np.full(7, -np.inf), own, 10)
        assert (scores[q, t] == found).all()
        for i in range(7):
            least = np.sort(scores[i])[-10]
            assert set(t[q == i]) >= set(np.nonzero(scores[i] >= least)[0])
        assert len(q) < scores.size  # bounds leave some out


# --- spelling variants


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def groups_by_hand(words, ratio=10):
    form, rows = {}, {}
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
        rows[w] = (n, len(others))
    out = []
    for w, (n, n_near) in rows.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, n_near, words[form[w]] if form[w] is not None else None))
    return sorted(out, key=repr)


def test_tries_accept_what_is_near():
    rng = random.Random(1)
    made = lambda letters, least: "".join(rng.choice(letters) for _ in range(rng.randint(least, 6)))
    for _ in range(60):
        words = sorted({made("abé𝄞", 0) for _ in range(rng.choice([0, 1, 60]))})
        held = spelling.unpack(spelling.pack(words, np.arange(len(words)) + 1))
        asked = [made("abcé", 0) for _ in range(30)] + words
        got = [(int(w), held.word(int(v))) for w, v in zip(*spelling.neighbours(held, asked), strict=True)]
        assert sorted(got) == sorted((i, w) for i, a in enumerate(asked) for w in words if near(a, w))


@pytest.mark.parametrize("shard", [7, 65_536])
def test_groups_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(spelling, "SHARD_WORDS", shard)
    monkeypatch.setattr(spelling, "WAVE_BYTES", 300 if shard == 7 else 1 << 20)  # several waves
    rng = random.Random(2)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(0, 5))): rng.choice([2, 2, 3, 20, 30, 400, 5000]) for _ in range(80)}
    words |= {"x" * 3000: 2, "x" * 3001: 50}
    df = spark.createDataFrame([*words.items(), (None, 9)], "word string, n long")
    assert sorted(map(tuple, spelling.spelling_groups(df).collect()), key=repr) == groups_by_hand(words)
    assert spelling.spelling_groups(df.limit(0)).count() == 0


def test_words_with_slips(spark):
    texts = [(i, "Straßen straßen ABCDEFGH abcdefgh×÷ kurz, " + "wörterbuch " * 3) for i in range(40)]
    texts += [(None, "abcdefgh abcdefgh"), (50, None), (51, ""), (52, "z" * 20_000 + " " + "z" * 20_000), (53, "日本語日本語日本 abcdefgh")]
    df = spark.createDataFrame([(i, t, 1, "r") for i, t in texts], "doc_id long, text string, n int, _other string")
    found = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            run = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            found[run] += len(run) >= 7
    assert {r.word: r.n for r in spelling.word_counts(df, change=spelling.slips("doc_id")).collect()} == {w: n for w, n in found.items() if n >= 2}


# --- conversation trie


def nodes_by_hand(convs):
    """convs: id to list of (role, text)."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    words = lambda t: len([w for w in re.split(r"[\x20\x09-\x0D]+", t) if w])
    out, sums = [], {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * words(path[-1][1]) if path else 0
        below = [sums[c] for c in children[path]]
        sums[path] = (sum(b[0] for b in below) or int(not below), own + sum(b[1] for b in below))
    for path, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(path))
        out.append((min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), len(children[path]), *sums[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rebuilt_by_hand(convs):
    out = {}
    for c, turns in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 4, convs.get(c - c % 20, [])
        out[c] = base[:h] + turns[h:]
    return out


def table_of(spark, convs, more=()):
    rows = [(c, t, r, x, 0, "d") for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    random.Random(4).shuffle(rows)
    return spark.createDataFrame([*rows, *more], "conv_id long, turn long, role string, text string, depth int, digest string")


def test_trie_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 4)
    monkeypatch.setattr(trie.ids_digests, "__defaults__", (4,))
    rng = random.Random(6)
    convs = {c: [(rng.choice(["user", ""]), rng.choice(["a b", "a\tb c", "", "x" * 3000])) for _ in range(rng.randint(1, 5))] for c in rng.sample(range(200), 90)}
    convs |= {c: [("user", "same"), ("assistant", "one two three")] for c in range(300, 330)}  # a group of copies
    convs |= {400: [("u", str(i)) for i in range(60)], 401: [("u", str(i)) for i in range(40)] + [("u", "other")]}  # long ones
    got = trie.conversation_trie(table_of(spark, convs, [(None, 1, "user", "lost", 0, "")]))
    assert sorted(map(tuple, got.collect()), key=repr) == nodes_by_hand(convs)
    turns = trie.staged(trie.in_order(trie.marked(table_of(spark, convs))), "turns")
    assert sorted(map(tuple, trie.prefix_trie(*trie.rebuilt(turns)).collect()), key=repr) == nodes_by_hand(rebuilt_by_hand(convs))


def test_trie_of_odd_tables(spark):
    assert trie.conversation_trie(table_of(spark, {})).count() == 0
    # null turns come first, null roles and texts are empty, repeated rows all count
    df = spark.createDataFrame([(7, 1, "u", "second"), (7, None, None, "first"), (8, 0, "", "first"), (8, 5, "u", "second"), (8, 5, "u", "second"), (9, 0, "u", None)], "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, trie.conversation_trie(df).collect()), key=repr) == nodes_by_hand({7: [("", "first"), ("u", "second")], 8: [("", "first"), ("u", "second"), ("u", "second")], 9: [("u", "")]})
    # conversations of less than h turns, without a base, are rebuilt to nothing and belong to the root alone
    few = {c: [("u", "x")] for c in range(1, 20)}
    turns = trie.in_order(trie.marked(table_of(spark, few)))
    assert sorted(map(tuple, trie.prefix_trie(*trie.rebuilt(trie.staged(turns, "t"))).collect()), key=repr) == nodes_by_hand(rebuilt_by_hand(few))
