"""The pipeline over a small corpus against a brute-force version of its stages."""

import hashlib
import random
import re

import corpus_pipeline
import public_tokenizers
from cohortry.llm import jaccard_join
from tokenizers import Tokenizer

PASSAGE = " ".join(f"bench{i}" for i in range(14))


def corpus():
    rng = random.Random(5)
    texts = {i: " ".join(f"w{rng.randrange(5000)}" for _ in range(40)) for i in range(30)}
    texts[30] = texts[3]  # an exact copy
    texts[31] = texts[4] + " tail"  # a near copy
    texts[32] = "too short"
    texts[33] = "again and again and more " * 8
    texts[34] = texts[5] + " " + PASSAGE.upper() + " more"
    texts[35] = " ".join(f"u{rng.randrange(5000)}" for _ in range(40)) + " mail me@example.org or 192.168.0.1 now"
    texts[36] = None
    return texts


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)}


def brute(texts):
    kept = {}
    for i, t in texts.items():
        w = (t or "").split()
        runs = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        twice = {k + j for k, g in enumerate(runs) if runs.count(g) > 1 for j in range(5)}
        if len(w) >= 10 and 100 * len(twice) <= 20 * len(w):
            kept[i] = t
    first = {}
    for i in sorted(kept):
        a = shingles(kept[i])
        if not any(100 * len(a & shingles(kept[j])) >= 85 * len(a | shingles(kept[j])) for j in first):
            first[i] = kept[i]
    windows = {tuple(PASSAGE.split()[k : k + 10]) for k in range(5)}
    clean = {i: t for i, t in first.items() if not any(tuple(t.lower().split()[k : k + 10]) in windows for k in range(len(t.split())))}
    for i, t in clean.items():
        t = re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "<EMAIL>", t)
        clean[i] = re.sub(r"\b\d+\.\d+\.\d+\.\d+\b", "<IP>", t)
    return clean


def test_stages_equal_brute_force(spark, tmp_path):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(0, 30, 2)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    want = brute(texts)
    assert set(got) == set(want) and not {30, 31, 32, 33, 34, 36} & set(got) and "<EMAIL>" in want[35] and "<IP>" in want[35]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, t in want.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and got[i].ids == b"".join(x.to_bytes(4, "little") for x in ids)
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_similarity_stage_takes_five_words_and_four_fifths(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    edited = [w if i % 40 != 20 else f"v{i}" for i, w in enumerate(base)]  # five single words: 171 of 221 shingles
    texts = {1: base, 2: base[:166], 3: edited, 4: [f"u{i}" for i in range(200)]}
    texts |= {i: [f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(30, 300))] for i in range(5, 60)}
    cut = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in texts.items()}
    assert 0.82 < len(cut[1] & cut[2]) / len(cut[1] | cut[2]) < 0.83 and 0.77 < len(cut[1] & cut[3]) / len(cut[1] | cut[3]) < 0.8
    first = []
    for i in sorted(cut):
        if not any(100 * len(cut[i] & cut[j]) >= 80 * len(cut[i] | cut[j]) for j in first):
            first.append(i)
    docs = spark.createDataFrame([(i, " ".join(w), "en", "src0", 0) for i, w in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.by_similarity(spark, docs, "").collect()) == first and 2 not in first and 3 in first


def test_first_share_exceeds_what_the_threshold_leaves():
    spread = lambda percent: jaccard_join.SHARE_NUM * (100 - percent) / (jaccard_join.SHARE_DEN * 100)
    assert spread(85) == 0.2 and spread(80) > 0.25


def test_empty_table_and_repeated_rows(spark, tmp_path):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    rng = random.Random(7)
    text = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(30))
    own = [text() for _ in range(6)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(own)] * 3 + [(None, text(), None, None, None)] * 2 + [(9, None, None, None, None), (10, "", "", "", 0)]
    for name, docs in (("none", []), ("some", rows)):
        at = tmp_path / name
        spark.createDataFrame(docs, kinds).write.parquet(str(at / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(at / "labels.parquet"))
        spark.createDataFrame([], "item_id long, text string").write.parquet(str(at / "benchmark.parquet"))
        got = corpus_pipeline.run(spark, str(at)).collect()
        assert sorted((r.doc_id is None, r.doc_id) for r in got) == ([] if name == "none" else [(False, i) for i in range(6)] + [(True, None)])


def test_stages_take_documents_with_more_columns(spark):
    names = ["doc_id", "text", "lang", "source", "n_chars", "_id", "_text", "_words", "row", "node", "digest", "kept", "base", "spans"]
    docs = spark.createDataFrame([(i, " ".join(f"w{i}-{k}" for k in range(20)), "en", "s", 9, *"abcdefghi") for i in range(4)], names)
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.mode("overwrite").parquet(spark.conf.get("spark.checkpoint.dir") + "/tables/labels.parquet")
    spark.createDataFrame([(1, "x y")], "item_id long, text string").write.mode("overwrite").parquet(spark.conf.get("spark.checkpoint.dir") + "/tables/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, spark.conf.get("spark.checkpoint.dir") + "/tables")
        assert out.count() == 4 and (name == corpus_pipeline.STAGES[-1][0] or out.columns == corpus_pipeline.COLUMNS), name
