"""N-gram Jaccard self-join, size-aware: small sets meet in fixed-size subsets, large ones in inverted lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.common import ascii_lower, small, staged, table, words_of
from cohortry.llm.components import components

GAP = r"[\x20\x09-\x0D]"
#: The first test counts shingles whose hash is in the lowest SHARE_NUM/SHARE_DEN times (1 - threshold) of all hashes. The
#: share is more than 1 - threshold, so that most documents without links can be told by it.
SHARE_NUM, SHARE_DEN = 4, 3
#: Lists of up to this many documents are compared in full; longer ones are described by what differs from their centre.
STAR = 16
#: In so many first rounds, long lists with the same least document are treated as one group: most of them are alike.
MERGED_ROUNDS = 1
#: Lists of documents with a common difference are compared with up to this many of them, else are groups again.
ASKERS = 128
#: Candidate boundaries between small and large sets.
BOUNDARIES = (0, 4, 8, 16, 32, 64, 128, 256)


def shingles(words: Column, k: int) -> Column:
    """Hashes of the distinct runs of k words; of all words if there are fewer."""
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.xxhash64(F.slice(words, i, k)))
    return F.when(n >= k, F.array_distinct(runs)).when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))


def tokenized(df: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """id, node (128-bit digest of the words), the distinct shingles and their number n."""
    words = df.select(F.col(doc_id).alias("id"), words_of(ascii_lower(F.col(text)), GAP).alias("words"))
    cut = words.select("id", F.struct(F.xxhash64(F.lit(1), "words").alias("a"), F.xxhash64(F.lit(2), "words").alias("b")).alias("node"), shingles(F.col("words"), k).alias("shingles"))
    return cut.withColumn("n", F.size("shingles"))


def early(shingle: Column, percent: int) -> Column:
    """Whether a shingle is of the share that comes first in the order: a fifth of all at 85 percent."""
    return shingle < F.lit(min(-(2**63) + 2**64 * SHARE_NUM * (100 - percent) // (SHARE_DEN * 100), 2**63 - 1))


def prefix_size(n: Column, percent: int) -> Column:
    """Linked sets share an element among so many first ones of each: n less the overlap needed, plus one."""
    return n - F.ceil(n * percent / 100).cast("int") + 1


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs left, right of nodes whose sets are similar enough, by exact intersection."""
    one = sets.select(F.col("node").alias("left"), F.col("shingles").alias("_l"))
    two = sets.select(F.col("node").alias("right"), F.col("shingles").alias("_r"))
    met = pairs.join(one, "left").join(two, "right").withColumn("shared", F.size(F.array_intersect("_l", "_r")))
    return met.where(100 * F.col("shared") >= percent * (F.size("_l") + F.size("_r") - F.col("shared"))).select("left", "right").distinct()


def sized(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs of different nodes that may be linked, each once, the lesser node on the left. Sets of n and m elements, u and
    v of which other documents have too, share at most the lesser of u and v."""
    most = F.least("u", "v")
    fit = (100 * most >= percent * (F.col("n") + F.col("m") - most)) & (F.col("node") != F.col("other"))
    return pairs.where(fit).select(F.least("node", "other").alias("left"), F.greatest("node", "other").alias("right")).distinct()


def jaccard_links(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", k: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """Self-join of shingle sets with Jaccard similarity of ``percent`` / 100 or more.

    Returns (members, links). ``members`` has a row for each row of ``df``: id, node, n (size of its set). A node is a
    class of documents with the same words. ``links`` has pairs of nodes, left < right, whose connected components are
    those of all linked pairs; in long lists, pairs within a component that is known already are not listed.

    Words are runs of other than ASCII white space with A-Z lower-cased; fewer than ``k`` words are one shingle. Null and
    empty texts have n = 0 and no links. Null ids are kept. Repeated rows are members of one node. Other columns are not
    read. An empty table gives empty results.

    Method. In any common order, linked sets share an element in their prefixes of n - ceil(t n) + 1, and two elements in
    prefixes longer by one. So a document with as many shingles of its own as its prefix is long has no links. This is
    tested on a fixed share of hashes first, over all documents, then on whole sets, over those left. Of these, the order
    is by document frequency. Small sets emit each pair of elements of the longer
    prefix, large sets each element of the shorter; the boundary is the cheapest of BOUNDARIES by the emitted pairs
    against the lengths of the lists scanned. Sets near the boundary do both. Lists of more than STAR documents are never
    compared in full: see ``long_lists``.
    """
    df = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    tokens = tokenized(df, "id", "text", k)
    base = staged(tokens.select("id", "node", "n", F.filter("shingles", lambda s: early(s, percent)).alias("first")), "base")
    members = base.select("id", "node", "n")
    classes = base.where("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first(F.size("first")).alias("m"))

    each = base.select(F.col("node.a").alias("doc"), F.explode("first").alias("shingle"))
    common = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = each.join(common, "shingle").groupBy("doc").agg(F.count(F.lit(1)).alias("among"))
    # shingles of the share that no other row has; a repeated document has none
    kept = classes.join(shared, F.col("node.a") == F.col("doc"), "left")
    kept = kept.where(F.col("m") - F.coalesce("among", F.lit(0)) < prefix_size(F.col("n"), percent))
    kept = staged(kept.select("node", "id", "n"), "kept")

    ids = kept.select(F.col("id").alias("_id")).distinct()
    wanted = df.join(F.broadcast(ids) if small(ids) else ids, F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    sets = staged(tokenized(wanted, "id", "text", k).drop("n", "id").join(kept, "node").select("node", "n", "shingles"), "sets")
    if sets.groupBy("node").count().where("count > 1").limit(1).count():  # rows with equal id and text
        sets = staged(sets.dropDuplicates(["node"]), "sets")

    # the same over whole sets, among those left: what they share, rarest first
    # (nodes of which half of the digest is equal would look up each other's shingles too, which takes none from them)
    every = sets.select(F.col("node.a").alias("doc"), F.explode("shingles").alias("shingle"))
    common = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = every.join(common, "shingle").groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("shared"))
    room = prefix_size(F.col("n"), percent) + 1 - (F.col("n") - F.size("shared"))
    heads = kept.join(shared, F.col("node.a") == F.col("doc")).withColumn("room", room).where("room > 1")
    head = F.slice("shared", 1, F.col("room"))
    heads = staged(heads.select("node", "n", F.size("shared").alias("u"), "room", F.transform(head, lambda s: s["shingle"]).alias("head"), F.aggregate(head, F.lit(0).cast("bigint"), lambda t, s: t + F.when(s["df"] <= STAR, s["df"]).otherwise(1)).alias("scan")), "heads")
    edge = _boundary(heads, percent)

    upto = edge * 100 / percent
    few = F.flatten(F.transform(F.sequence(F.lit(1), F.size("head") - 1), lambda i: F.transform(F.slice("head", i + 1, F.size("head")), lambda s: F.xxhash64(F.lit("pair"), F.least(F.element_at("head", i), s), F.greatest(F.element_at("head", i), s)))))
    subsets = F.when((F.col("n") == 1) & (F.lit(edge) >= 1), F.transform("head", lambda s: F.xxhash64(F.lit("one"), s))).when((F.col("n") <= upto) & (F.size("head") > 1), few)
    lists = F.when(F.col("n") > edge, F.slice("head", 1, F.greatest(F.col("room") - 1, F.lit(0))))
    none = F.array().cast("array<bigint>")
    rows = heads.select("node", "n", "u", F.explode(F.concat(F.coalesce(subsets, none), F.coalesce(lists, none))).alias("key"))
    lengths = rows.groupBy("key").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    rows = staged(rows.join(lengths, "key"), "rows")

    short = rows.where(F.col("length") <= STAR).groupBy("key").agg(F.collect_list(F.struct("node", "n", "u")).alias("all"))
    crossed = short.select("all", F.explode("all").alias("x")).select("x.*", F.explode("all").alias("y")).select("node", "n", "u", F.col("y.node").alias("other"), F.col("y.n").alias("m"), F.col("y.u").alias("v"))
    pairs = sized(crossed.where(F.col("node") < F.col("other")), percent)
    long = rows.where(F.col("length") > STAR).select("key", "node", "n")
    sure, more = long_lists(long, sets, percent)
    pairs = staged(pairs.union(more).distinct(), "pairs") if more is not None else pairs
    links = verified(pairs, sets, percent)
    return members, staged(links.union(sure).distinct() if sure is not None else links, "links")


def long_lists(lists: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Links within long lists (key, node, n): (sure, pairs), both left < right. ``sure`` are linked, ``pairs`` may be.

    The centre of a group is the set of shingles that more than half of its documents have; d is the number of shingles in
    which a document differs from it. With c = (1 - t) / (1 + t), two documents of n and m shingles are linked if they
    differ from each other in c (n + m) shingles or fewer, and they differ in d + e less twice the differences that they
    share. So, with f = d - c n:

    * f(x) + f(y) <= 0: surely linked. All such pairs are connected by a star around the document with the least f.
    * otherwise they must share at least (f(x) + f(y)) / 2 > 0 differences. One of the two, x, is outside the star, and has
      one of these among all but the last ceil((f(x) + least f) / 2) - 1 of its differences, in any order: the rarest
      first. These look up all differences of the others.

    Lists of documents with a common difference are joined with up to ASKERS of them that look up; lists that more look up
    are groups again. All documents of such a list agree in one more shingle, so this ends. A round takes space in
    proportion to its lists.
    """
    sure = pairs = None
    share, rounds = 2 * (100 + percent), 0
    while lists.limit(1).count():
        if rounds < MERGED_ROUNDS:
            first = lists.groupBy("key").agg(F.min("node").alias("group"))
            members = lists.join(first, "key").select("group", "node", "n").distinct()
        else:
            members = lists.select(F.struct(F.col("key").alias("a"), F.lit(0).cast("bigint").alias("b")).alias("group"), "node", "n").distinct()
        rounds += 1
        members = staged(members, "members")
        held = members.join(sets.select("node", "shingles"), "node")
        sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
        counts = held.select("group", F.explode("shingles").alias("shingle")).groupBy("group", "shingle").agg(F.count(F.lit(1)).alias("having"))
        # half of the documents have each of these: they are at most twice as many as shingles of a document
        centres = counts.join(sizes, "group").where(2 * F.col("having") > F.col("size")).groupBy("group").agg(F.collect_list("shingle").alias("centre"))
        centre = F.coalesce("centre", F.array().cast("array<bigint>"))
        differ = F.concat(F.array_except("shingles", centre), F.array_except(centre, "shingles"))
        apart = held.join(centres, "group", "left").select("group", "node", "n", differ.alias("differ"))
        # f, times 100 + percent
        apart = staged(apart.withColumn("f", (100 + percent) * F.size("differ") - (100 - percent) * F.col("n")), "apart")
        ends = apart.groupBy("group").agg(F.min(F.struct("f", "node")).alias("hub"), F.max("f").alias("most"))
        near = apart.join(ends, "group").where((F.col("f") + F.col("hub.f") <= 0) & (F.col("node") != F.col("hub.node")))
        near = staged(near.select(F.least("node", F.col("hub.node")).alias("left"), F.greatest("node", F.col("hub.node")).alias("right")).distinct(), "sure")
        sure = near if sure is None else sure.union(near)

        each = apart.join(ends.where(F.col("most") + F.col("hub.f") > 0), "group").select("group", "node", "n", "f", F.col("hub.f").alias("low"), F.explode("differ").alias("shingle"))
        often = each.groupBy("group", "shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        common = each.join(often, ["group", "shingle"]).groupBy("group", "node", "n", "f", "low").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("common"))
        # those outside the star may be linked with any, the others only with those outside
        outside = F.col("f") + F.col("low") > 0
        enough = F.when(outside, share * F.col("s") >= F.col("f") + F.col("low")).otherwise(share * F.col("s") > F.col("f") - F.col("low"))
        common = common.withColumn("s", F.size("common")).where(enough)
        probes = F.when(outside, F.col("s") - F.ceil((F.col("f") + F.col("low")) / share).cast("int") + 1).otherwise(0)
        entries = common.withColumn("probes", probes).select("group", "node", "n", "f", "s", "probes", F.posexplode("common").alias("at", "c"))
        entries = entries.select(F.xxhash64("group", "c.shingle").alias("key"), "node", "n", "f", "s", (F.col("at") < F.col("probes")).alias("asks"))
        entries = staged(entries, "entries")
        lengths = entries.groupBy("key").agg(F.count(F.lit(1)).alias("length"), F.count_if("asks").alias("asking"), F.min("f").alias("least"), F.min(F.when(F.col("asks"), F.col("f"))).alias("asker")).where("length > 1 and asking > 0")
        entries = entries.join(lengths, "key")
        few = entries.where(F.col("asking") <= ASKERS).select("key", "node", "f", "s", "asks")
        other = few.where("asks").select("key", F.col("node").alias("other"), F.col("f").alias("g"), F.col("s").alias("z"))
        met = few.join(other, (few["key"] == other["key"]) & (F.col("node") != F.col("other")) & (share * F.least("s", "z") >= F.col("f") + F.col("g")))
        found = staged(met.select(F.least("node", "other").alias("left"), F.greatest("node", "other").alias("right")).distinct(), "met")
        pairs = found if pairs is None else pairs.union(found)
        # those that could be linked with the most typical document of the list that asks, or if they ask, of all
        able = share * F.col("s") >= F.col("f") + F.when(F.col("asks"), F.col("least")).otherwise(F.col("asker"))
        lists = staged(entries.where((F.col("asking") > ASKERS) & able).select("key", "node", "n"), "lists")
    return sure, pairs


def _boundary(heads: DataFrame, percent: int) -> int:
    """The cheapest boundary: pairs emitted by the sets up to it, against the rows of lists and what they are compared with
    by the sets above. In a long list, a set is compared with the hub alone."""
    size = F.size("head").cast("bigint")
    costs = [
        F.coalesce(F.sum(F.when(F.col("n") <= x * 100 / percent, size * (size - 1) / 2)), F.lit(0.0)) + F.coalesce(F.sum(F.when(F.col("n") > x, F.col("scan") + size)), F.lit(0))
        for x in BOUNDARIES
    ]
    found = heads.agg(*[c.alias(f"c{i}") for i, c in enumerate(costs)]).first()
    return BOUNDARIES[min(range(len(BOUNDARIES)), key=lambda i: found[i])]


def jaccard_groups(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", k: int = 4, percent: int = 85) -> DataFrame:
    """One row for each row of ``df``: doc_id, n_shingles and component_id, the least id reachable by links.

    A document without words is its own component. Of a component whose ids are all null, component_id is null.
    """
    members, links = jaccard_links(df, text=text, doc_id=doc_id, k=k, percent=percent)
    labels = components(links, "left", "right")
    least = members.where("n > 0").groupBy("node").agg(F.min("id").alias("least"))
    groups = least.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = groups.join(named, "component").select("node", "component_id")
    out = members.join(nodes, "node", "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def one_of_each(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", k: int = 4, percent: int = 85) -> DataFrame:
    """``df`` with one row of each component of linked documents: the one of the least id, of these any one.

    Rows without words stay. All columns stay. Only rows that go, and rows that are repeated, are marked and joined.
    """
    members, links = jaccard_links(df, text=text, doc_id=doc_id, k=k, percent=percent)
    labels = components(links, "left", "right")
    counted = members.where("n > 0").groupBy("id", "node").agg(F.count(F.lit(1)).alias("rows"))
    parts = counted.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    kept = parts.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "node")).alias("kept"))
    marks = parts.join(kept, "component").withColumn("stays", (F.col("kept.node") == F.col("node")) & F.col("kept.id").eqNullSafe(F.col("id")))
    marks = staged(marks.where(~F.col("stays") | (F.col("rows") > 1)).select(F.col("id").alias("_id"), F.col("node").alias("_mark"), "stays"), "marks")
    words = words_of(ascii_lower(F.col(text)), GAP)
    held = df.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), words.alias("words"))
    held = held.select("row", "id", F.struct(F.xxhash64(F.lit(1), "words").alias("a"), F.xxhash64(F.lit(2), "words").alias("b")).alias("node"))
    met = held.join(F.broadcast(marks) if small(marks) else marks, F.col("id").eqNullSafe(F.col("_id")) & (F.col("node") == F.col("_mark")), "left")
    alone = met.where(F.col("stays").isNull()).select("row")
    return alone.unionByName(met.where("stays").dropDuplicates(["id", "node"]).select("row")).select("row.*")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE_OP8 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT rid, w[i:i + 3] AS sh
  FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
i AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM s AS a JOIN s AS b ON a.sh = b.sh AND a.rid <> b.rid GROUP BY a.rid, b.rid),
l AS (SELECT x, y FROM i JOIN n AS p ON p.rid = x JOIN n AS q ON q.rid = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
r(x, y) AS (SELECT rid, rid FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, CAST(min(e.doc_id) AS BIGINT) AS component_id
FROM d JOIN r ON r.x = d.rid JOIN d AS e ON e.rid = r.y LEFT JOIN n ON n.rid = d.rid
GROUP BY d.rid, d.doc_id
"""

QUERIES = {"op8_jaccard_join": op8_jaccard_join}
ORACLE = {"op8_jaccard_join": ORACLE_OP8}
