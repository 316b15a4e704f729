"""Conversation prefix trie: each conversation's first owned depth by binary search in prefix-digest minima, owned chains as
the tree, sums over chains from the bottom up."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.common import crc32_sql, staged, table
from cohortry.operators.numbering import running
from cohortry.operators.skew import lookup

#: Conversation ids that one row holds when those of equal conversations are joined for their digest.
CHUNK = 4096
_PIECES = [f"_d{i}" for i in range(4)]


def marked(df: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, mark (digest of role and text) and words of each turn. Null roles and texts are empty; rows without a
    conversation are left out."""
    said_by, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    mark = F.sha2(F.concat(F.octet_length(said_by).cast("string"), F.lit(":"), said_by, said).cast("binary"), 256)
    words = F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return df.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), mark.alias("mark"), words.alias("words"))


def in_order(turns: DataFrame) -> DataFrame:
    """Adds ``depth``, the place of each turn in its conversation: by turn, null first, then by mark; equal rows all count."""
    return running(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), "mark"], {"depth": F.lit(1)}).drop("turn")


def prefixes_of(turns: DataFrame) -> DataFrame:
    """conv_id, depth, digest (of all turns up to this one) and words. The digest has four sums of 32 bits of SHA-256 over
    place and mark, so it adds up along conversations of any length, in parts."""
    place = F.sha2(F.concat_ws(":", "depth", "mark").cast("binary"), 256)
    made = turns.withColumn("_h", place)
    pieces = {c: F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("long") for i, c in enumerate(_PIECES)}
    summed = running(made, ["conv_id"], ["depth"], pieces)
    return summed.select("conv_id", "depth", F.concat_ws("-", *_PIECES).alias("digest"), "words")


def first_owned(members: DataFrame, prefixes: DataFrame, minima: DataFrame, total: int) -> DataFrame:
    """``members`` (conv_id, n_turns) with ``first``, the least depth at which a conversation is the smallest member of its
    prefix's node, and n_turns + 1 if there is none. Who owns a prefix owns all longer ones, so depth is searched by halves:
    in each round all open conversations look their middle prefix up in the minima."""
    state = staged(members.select("conv_id", "n_turns", F.lit(1).cast("long").alias("lo"), (F.col("n_turns") + 1).alias("hi")), "search")
    digests = prefixes.select("conv_id", "depth", "digest")
    owners = minima.select("depth", "digest", "owner", "n_convs")
    while state.where("lo < hi").limit(1).count():
        probes = staged(state.where("lo < hi").withColumn("depth", F.floor((F.col("lo") + F.col("hi")) / 2).cast("long")).join(digests, ["conv_id", "depth"]), "probes")
        met, owned = lookup(probes, owners, ["depth", "digest"], "n_convs", total), F.col("owner") == F.col("conv_id")
        moved = met.select("conv_id", "n_turns", F.when(owned, F.col("lo")).otherwise(F.col("depth") + 1).alias("lo"), F.when(owned, F.col("depth")).otherwise(F.col("hi")).alias("hi"))
        state = staged(state.where("lo >= hi").unionByName(moved), "search")
    return state.select("conv_id", "n_turns", F.col("lo").alias("first"))


def parents_of(owned: DataFrame, prefixes: DataFrame, minima: DataFrame, root: int, total: int) -> DataFrame:
    """``owned`` with ``parent``, the owner of the prefix one shorter than the first owned one; null for the root's chain."""
    under = owned.where(F.col("first") > 1).withColumn("depth", F.col("first") - 1)
    under = staged(under.join(prefixes.select("conv_id", "depth", "digest"), ["conv_id", "depth"]), "under")
    met = lookup(under, minima.select("depth", "digest", "owner", "n_convs"), ["depth", "digest"], "n_convs", total)
    tops = owned.where(F.col("first") <= 1).select("conv_id", "n_turns", "first", F.when(F.col("first") == 1, F.lit(root)).alias("parent"))
    return tops.unionByName(met.select("conv_id", "n_turns", "first", F.col("owner").alias("parent")))


def summed_up(chains: DataFrame, values: list[str]) -> DataFrame:
    """Each chain (conv_id, parent, values) with its values summed over all chains that hang on it, directly or not.

    From the bottom up by doubling: after round k a chain has the sums of all chains less than 2^k below it; in the next
    it gets those of the chains that are 2^k below. So there are as many rounds as the height has binary digits.
    """
    state, total = staged(chains.select("conv_id", F.col("parent").alias("up"), *values), "chains"), chains.count()
    while state.where("up IS NOT NULL").limit(1).count():
        gained = staged(state.where("up IS NOT NULL").groupBy(F.col("up").alias("conv_id")).agg(F.count(F.lit(1)).alias("below"), *[F.sum(v).alias(f"_{v}") for v in values]), "gained")
        # where an ancestor's own ancestor is: one row for each that has chains below it
        above = staged(gained.select("conv_id", "below").join(state.select("conv_id", F.col("up").alias("next")), "conv_id").select(F.col("conv_id").alias("up"), "below", "next"), "above")
        moved = lookup(state.where("up IS NOT NULL"), above, ["up"], "below", total).select("conv_id", F.col("next").alias("up"), *values)
        moved = moved.unionByName(state.where("up IS NULL"))
        grown = moved.join(gained.drop("below"), "conv_id", "left")
        state = staged(grown.select("conv_id", "up", *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values]), "chains")
    return state.drop("up")


def ids_digests(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids of each (depth, digest). Ids are joined in chunks; a node with several
    has its chunks hashed one after another in order, with no more than some of them in memory."""
    placed = running(ends, ["depth", "digest"], ["conv_id"], {"place": F.lit(1)})
    held = placed.groupBy("depth", "digest", F.floor((F.col("place") - 1) / chunk).alias("chunk")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    held = staged(held, "ends")
    long = staged(held.where("chunk > 0").select("depth", "digest").distinct(), "long_ends")
    short = held.join(long, ["depth", "digest"], "left_anti").select("depth", "digest", F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    if not long.limit(1).count():
        return short

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        done: list[tuple] = []
        for batch in batches:
            for depth, key, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "digest", "ids")), strict=True):
                if (depth, key) != at:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = (depth, key), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done]), pa.array([d[2] for d in done])], ["depth", "digest", "ends_sha256"])
                done = []
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[1]]), pa.array([digest.hexdigest()])], ["depth", "digest", "ends_sha256"])

    many = held.join(long, ["depth", "digest"], "left_semi").repartition("depth", "digest").sortWithinPartitions("depth", "digest", "chunk")
    return short.unionByName(many.mapInArrow(fold, "depth long, digest string, ends_sha256 string"))


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row for each node of the prefix tree: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256 (of the ids of members that end there).

    ``turns``: conv_id, depth (1 to n without gaps), mark, words. ``members``: conv_id (distinct, not null) and n_turns, also
    of conversations without turns, which are members of the root alone. A node is named by its smallest member and its
    depth. Equal conversations share all nodes. No members, no nodes. A conversation, a prefix or a group of equal
    conversations of any size is spread over tasks; only the ids of equal conversations pass, in chunks, one after another.
    """
    members = staged(members.select("conv_id", F.col("n_turns").cast("long").alias("n_turns")), "members")
    total, root = members.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    prefixes = staged(prefixes_of(turns), "prefixes")
    minima = staged(prefixes.groupBy("depth", "digest").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words")), "minima")
    searched = first_owned(members, prefixes, minima, total)
    # the root belongs to the chain of the smallest id, whose first owned depth is therefore 0
    owned = searched.withColumn("first", F.when(F.col("conv_id") == F.lit(root), F.lit(0).cast("long")).otherwise(F.col("first"))).where("first <= n_turns")
    chains = staged(parents_of(owned, prefixes, minima, root, total), "chains")
    links = chains.where("parent IS NOT NULL").select("conv_id", "parent", (F.col("first") - 1).alias("at"))

    top = members.limit(0).select("conv_id", "n_turns").unionByName(members.where(F.col("conv_id") == F.lit(root))).select(F.col("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit("").alias("digest"), F.lit(total).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("words"))
    nodes = minima.select(F.col("owner").alias("conv_id"), "depth", "digest", "n_convs", "words").unionByName(top)
    hung = links.groupBy(F.col("parent").alias("conv_id"), F.col("at").alias("depth")).agg(F.count(F.lit(1)).alias("hung"))
    heads = chains.select("conv_id", F.col("first").alias("depth"), "parent", F.lit(True).alias("is_head"))
    tails = chains.select("conv_id", F.col("n_turns").alias("depth"), F.lit(0).alias("more"))
    at = ["conv_id", "depth"]
    nodes = nodes.join(hung, at, "left").join(heads, at, "left").join(tails, at, "left")
    nodes = nodes.withColumn("n_children", F.coalesce("hung", F.lit(0)) + F.coalesce("more", F.lit(1)))
    nodes = nodes.withColumns({
        "parent_conv_id": F.when(F.col("is_head"), F.col("parent")).otherwise(F.col("conv_id")),
        "leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words"),
    })
    nodes = staged(nodes.select(*at, "digest", "parent_conv_id", "n_convs", "n_children", "leaves", "saved"), "nodes")

    of_chain = nodes.groupBy("conv_id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    totals = summed_up(staged(chains.select("conv_id", "parent").join(of_chain, "conv_id"), "chain_sums"), ["leaves", "saved"])
    below = links.join(totals, "conv_id").groupBy(F.col("parent").alias("conv_id"), F.col("at").alias("depth")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    filled = nodes.join(below, at, "left")
    # a node has what stands at its depth or deeper in its chain, and what hangs there
    whole = running(filled, ["conv_id"], [F.col("depth").desc()], {"n_leaves": F.col("leaves") + F.coalesce("l", F.lit(0)), "saved_tokens": F.col("saved") + F.coalesce("s", F.lit(0))})

    last = members.where("n_turns > 0").join(prefixes.select("conv_id", F.col("depth").alias("n_turns"), "digest"), ["conv_id", "n_turns"]).select("conv_id", F.col("n_turns").alias("depth"), "digest")
    ends = last.unionByName(members.where("n_turns = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("digest")))
    ended = whole.join(ids_digests(ends), ["depth", "digest"], "left")
    return ended.select(*at, "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def conversation_trie(df: DataFrame, **names: str) -> DataFrame:
    """The prefix tree of conversations as they are; see ``prefix_trie``. Other columns are not read."""
    turns = staged(in_order(marked(df, **names)), "turns")
    return prefix_trie(turns, turns.groupBy("conv_id").agg(F.max("depth").alias("n_turns")))


def shared_starts(conv_id: Column) -> tuple[Column, Column]:
    """The conversation whose start a rebuilt one has, and of how many turns."""
    return conv_id - conv_id % 20, (F.crc32(conv_id.cast("string").cast("binary")) % 4).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and members of the rebuilt conversations: the first h turns of the conversation whose id is the next lower
    multiple of 20 (all, if fewer; none, if there is none), then the own turns after the first h."""
    base, h = shared_starts(F.col("conv_id"))
    own = staged(turns.groupBy("conv_id").agg(F.max("depth").alias("own")), "own")
    lengths = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = own.withColumns({"base": base, "h": h}).join(lengths, "base", "left").withColumn("copied", F.least("h", F.coalesce("base_own", F.lit(0))))
    convs = staged(convs.select("conv_id", "own", "base", "h", "copied"), "convs")
    total = turns.count()
    kept = lookup(turns, convs.select("conv_id", "own", "h", "copied"), ["conv_id"], "own", total).where(F.col("depth") > F.col("h"))
    kept = kept.select("conv_id", (F.col("copied") + F.col("depth") - F.col("h")).alias("depth"), "mark", "words")
    heads = turns.where("depth <= 3").select(F.col("conv_id").alias("base"), "depth", "mark", "words")
    copied = convs.where("copied > 0").select("conv_id", "base", "copied").join(heads, "base").where(F.col("depth") <= F.col("copied")).select("conv_id", "depth", "mark", "words")
    return kept.unionByName(copied), convs.select("conv_id", (F.col("copied") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = staged(in_order(marked(table(spark, sf_dir, "conversations"))), "turns")
    made, members = rebuilt(turns)
    return prefix_trie(made, members)


QUERIES = {"op13_conversation_trie": op13_conversation_trie}

ORACLE = {
    "op13_conversation_trie": rf"""WITH {crc32_sql('CAST(conv_id AS VARCHAR)', 'SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL')},
turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS k, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c.conv_id, crc % 4 AS h, c.conv_id - c.conv_id % 20 AS base, (SELECT count(*) FROM turns AS t WHERE t.conv_id = c.conv_id - c.conv_id % 20) AS base_own FROM crcs AS c),
made AS (SELECT c.conv_id, t.k AS depth, role, text FROM convs AS c JOIN turns AS t ON t.conv_id = base AND t.k <= h
  UNION ALL SELECT c.conv_id, least(h, base_own) + t.k - h, role, text FROM convs AS c JOIN turns AS t ON t.conv_id = c.conv_id AND t.k > h),
prefixes AS (SELECT conv_id, depth, list({{'r': role, 't': text}}) OVER (PARTITION BY conv_id ORDER BY depth) AS path, text FROM made
  UNION ALL SELECT conv_id, 0, [], '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS n FROM prefixes GROUP BY conv_id),
members AS (SELECT p.conv_id, p.depth, p.path, p.text, min(p.conv_id) OVER node AS owner, l.n FROM prefixes AS p JOIN lengths AS l USING (conv_id) WINDOW node AS (PARTITION BY p.depth, p.path)),
nodes AS (SELECT owner, depth, count(*) AS n_convs, any_value(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS words,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = n), '') AS ends FROM members GROUP BY owner, depth),
edges AS (SELECT DISTINCT a.owner, a.depth, b.owner AS up FROM members AS a JOIN members AS b ON a.conv_id = b.conv_id AND b.depth = a.depth - 1),
children AS (SELECT up AS owner, depth - 1 AS depth, count(*) AS n FROM edges GROUP BY ALL),
above AS (SELECT DISTINCT a.owner, a.depth, b.owner AS o, b.depth AS d FROM members AS a JOIN members AS b ON a.conv_id = b.conv_id AND b.depth <= a.depth),
sums AS (SELECT o AS owner, d AS depth, sum((n_convs - 1) * words) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM above AS a JOIN nodes AS x ON x.owner = a.owner AND x.depth = a.depth LEFT JOIN children AS c ON c.owner = a.owner AND c.depth = a.depth GROUP BY ALL)
SELECT x.owner AS conv_id, CAST(x.depth AS BIGINT) AS depth, e.up AS parent_conv_id, x.n_convs, coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM nodes AS x JOIN sums AS s ON s.owner = x.owner AND s.depth = x.depth LEFT JOIN edges AS e ON e.owner = x.owner AND e.depth = x.depth LEFT JOIN children AS c ON c.owner = x.owner AND c.depth = x.depth"""
}
