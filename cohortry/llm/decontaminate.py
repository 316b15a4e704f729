"""Benchmark decontamination by winnowing: select minimum gram hashes, join them, extend the hits exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.common import ascii_lower, small, staged, table, words_of

#: What stands between words once A-Z are lower-cased: ASCII other than digits and letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WINDOW = 10
#: Words in a hashed gram. A sliding window of WINDOW - GRAM + 1 gram hashes then has one winner at least, so every
#: shared span of WINDOW words shares a winner with the same offset in it.
GRAM = 5
#: The low bits of a fingerprint are the position of its gram, the high bits its hash. 2 GB of text have fewer words.
PLACE_BITS = 30
PLACE = (1 << PLACE_BITS) - 1
#: The kind of a fingerprint that every document has besides its own: it keeps documents without hits in the result. It
#: has a place that no gram has, and one of KEEPERS hashes by document, so that a shuffle deals them out.
ALWAYS, KEEPERS = -1, 256


def grams(words: Column, k: int, tag: int) -> Column:
    """A fingerprint for each k consecutive words; ``tag`` separates kinds."""
    mark = lambda i: F.xxhash64(F.lit(tag), F.slice(words, i + 1, k)).bitwiseAND(F.lit(~PLACE)).bitwiseOR(i.cast("long"))
    return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(0), F.size(words) - k), mark)).otherwise(_none())


def winnow(prints: Column, width: int) -> Column:
    """The minimum of each ``width`` consecutive fingerprints, leftmost on ties, each once."""
    last = F.greatest(F.size(prints) - width, F.lit(0))
    least = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_min(F.slice(prints, i + 1, width)))
    return F.when(F.size(prints) > 0, F.array_distinct(least)).otherwise(_none())


def _none() -> Column:
    return F.array().cast("array<bigint>")


def fingerprinted(df: DataFrame, short: list[int], window: int, gram: int) -> DataFrame:
    """Add ``prints``: winnowed grams for windows of full length, and all grams of each length in ``short``."""
    full = F.when(F.size("words") >= window, grams(F.col("words"), gram, 0)).otherwise(_none())
    marked = df.withColumn("_grams", full).withColumn("_grams", winnow(F.col("_grams"), window - gram + 1))
    return marked.withColumn("prints", F.concat("_grams", *[grams(F.col("words"), m, m) for m in short])).drop("_grams")


def item_windows(benchmark: DataFrame, text: str, item_id: str, window: int) -> DataFrame:
    """Each distinct window of the benchmark with the sorted ids of its items: words, n, item_ids."""
    words = benchmark.select(F.col(item_id).alias("item_id"), words_of(ascii_lower(F.col(text)), GAP).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    cut = words.where(F.size("words") > 0).select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item_id").alias("item_ids")).withColumn("n", F.size("words"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, *, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Words of documents that lie in a window of ``window`` consecutive benchmark words.

    An item of fewer words is one window; one without words has none. Returns doc_id, digest (xxhash64 of the text),
    n_words, hits (array of start and length, in words, of each occurrence), n_hit (words covered) and item_ids, one row
    for each row of ``documents``. Null and empty texts have no words and no hits. Rows with equal id and text are repeated in the
    result; other columns of the inputs are not read, so they cannot clash. A null item id marks words but is not listed.
    An empty benchmark hits nothing.

    The benchmark side is broadcast if its windows were counted to be few, else both joins shuffle and the words of the
    documents hit are fetched again.
    """
    windows = staged(item_windows(benchmark, item_text, item_id, window), "windows")
    few = small(windows)
    short = sorted(r.n for r in windows.where(F.col("n") < window).select("n").distinct().collect())
    own = fingerprinted(windows.where(F.col("n") == window).select("words"), [], window, gram)
    long_prints = own.select(F.explode("prints").alias("print"), F.lit(0).alias("kind"))
    for m in short:
        one = fingerprinted(windows.where(F.col("n") == m).select("words"), [m], window, gram)
        long_prints = long_prints.union(one.select(F.explode("prints"), F.lit(m)))
    heads = long_prints.select(F.col("print").bitwiseAND(F.lit(~PLACE)).alias("head"), "kind").distinct()
    if few:
        heads = F.broadcast(heads)

    docs = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    docs = docs.select("doc_id", F.xxhash64("_text").alias("digest"), words_of(ascii_lower(F.col("_text")), GAP).alias("words"))
    prints = fingerprinted(docs, short, window, gram).withColumn("n_words", F.size("words"))
    keeper = F.shiftleft(F.pmod(F.xxhash64("doc_id", "digest"), F.lit(KEEPERS)), PLACE_BITS).bitwiseOR(F.lit(PLACE))
    each = lambda *kept: prints.select("doc_id", "digest", "n_words", *kept, F.explode(F.concat("prints", F.array(keeper))).alias("print"))
    head = F.col("print").bitwiseAND(F.lit(~PLACE))
    place = F.col("print").bitwiseAND(F.lit(PLACE)).cast("int").alias("place")
    every = heads.select("head", "kind").union(heads.sparkSession.range(KEEPERS).select(F.shiftleft("id", PLACE_BITS), F.lit(ALWAYS)))
    every = F.broadcast(every) if few else every
    is_always = (F.col("print").bitwiseAND(F.lit(PLACE)) == PLACE) == (F.col("kind") == ALWAYS)
    if few:
        found = each("words").join(every, head == F.col("head")).where(is_always)
        found = found.select("doc_id", "digest", "n_words", "kind", place, F.when(F.col("kind") != ALWAYS, F.col("words")).alias("words"))
    else:
        found = each().join(every, head == F.col("head")).where(is_always).select("doc_id", "digest", "n_words", "kind", place)
        again = docs.join(found.where(F.col("kind") != ALWAYS).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct(), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left_semi")
        again = again.dropDuplicates(["doc_id", "digest"]).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "words")
        found = found.join(again, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")) & (F.col("kind") != ALWAYS), "left").drop("_id", "_digest")

    # extend: every window that holds the matched gram is compared word by word
    starts = F.when(F.col("kind") == 0, F.when(F.col("n_words") >= window, F.sequence(F.greatest(F.col("place") - (window - gram), F.lit(0)), F.least(F.col("place"), F.col("n_words") - window)))).when(F.col("kind") > 0, F.array("place"))
    length = F.when(F.col("kind") == 0, window).otherwise(F.col("kind"))
    tried = found.select("doc_id", "digest", "n_words", "kind", length.alias("length"), "words", F.explode_outer(starts).alias("start"))
    tried = tried.withColumn("words", F.slice("words", F.col("start") + 1, F.col("length")))
    known = windows.select(F.col("words").alias("_words"), F.xxhash64("words").alias("_hash"), "item_ids")
    met = tried.join(F.broadcast(known) if few else known, (F.xxhash64("words") == F.col("_hash")) & (F.col("words") == F.col("_words")), "left")

    hit = F.when(F.col("item_ids").isNotNull(), F.struct("start", "length"))
    grouped = met.groupBy("doc_id", "digest").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.sort_array(F.collect_set(hit)).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
        F.sum(F.when(F.col("kind") == ALWAYS, 1).otherwise(0)).alias("_copies"),
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("end")),
        lambda s, h: F.struct(
            (s["total"] + F.greatest(h["start"] + h["length"] - F.greatest(h["start"], s["end"]), F.lit(0))).alias("total"),
            F.greatest(s["end"], h["start"] + h["length"]).alias("end"),
        ),
        lambda s: s["total"],
    )
    repeated = grouped.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return repeated.select("doc_id", "digest", "n_words", "hits", covered.alias("n_hit"), "item_ids")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.sort_array(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_OP1 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, w[i:i + 9] AS win
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
dw AS (
  SELECT rid, i, l, w[i:i + l - 1] AS win
  FROM d, (SELECT DISTINCT len(win) AS l FROM bw) AS lens, unnest(range(1, len(w) - l + 2)) AS t(i) WHERE len(w) >= l),
hit AS (SELECT rid, i, l, item_id FROM dw JOIN bw USING (win)),
places AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + l)) AS p FROM hit) AS x GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hit) AS x GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (rid) LEFT JOIN items USING (rid)
"""

QUERIES = {"op1_decontaminate": op1_decontaminate}
ORACLE = {"op1_decontaminate": ORACLE_OP1}
