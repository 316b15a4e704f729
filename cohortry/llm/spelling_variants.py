"""Spelling variants: compact trie shards are broadcast, each word's distance-one Levenshtein automaton runs through every
shard depth-first, and what it accepts is reduced to a count and the best form."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.common import ascii_lower, crc32_sql, staged, table

#: Words, and code points of words, that a shard has at most (one word at least).
SHARD_WORDS, SHARD_CHARS = 65_536, 1 << 20
#: Bytes of packed shards that are broadcast at a time; further ones follow in further waves.
WAVE_BYTES = 16 << 20
#: Words whose automata run side by side, and words that a task is dealt.
AUTOMATA, TASK_WORDS = 1024, 16_384
#: A form occurs at least so many times as often as the word.
RATIO = 10


@dataclass
class Trie:
    """A trie in breadth-first order. ``keys`` (parent * letters + letter) ascend, and node i + 1 is the one that key i leads to."""

    letters: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    children: np.ndarray
    count: np.ndarray
    place: np.ndarray

    def child(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The child under each letter; 0 where there is none."""
        key = node * len(self.letters) + letter
        at = np.searchsorted(self.keys, key)
        found = (letter >= 0) & (at < len(self.keys))
        found[found] = self.keys[at[found]] == key[found]
        return np.where(found, at + 1, 0)

    def word(self, node: int) -> str:
        said = []
        while node:
            node, letter = divmod(int(self.keys[node - 1]), len(self.letters))
            said.append(chr(self.letters[letter]))
        return "".join(reversed(said))


def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words one after another, where each begins, and how long it is."""
    length = np.array([len(w) for w in words], np.int64)
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.cumsum(length) - length, length


def pack(words: list[str], counts: np.ndarray) -> bytes:
    """The trie of sorted words as bytes: for each node, breadth first, its letter and number of children; for each end of a
    word, its count and place."""
    flat, start, length = spelled(words)
    node, letters, parents = np.zeros(len(words), np.int64), [], []
    empty = np.nonzero(length == 0)[0]
    ends = [np.stack([node[empty], counts[empty], empty])]
    size, depth, active = 1, 0, np.arange(len(words))
    while len(active := active[length[active] > depth]):
        letter, parent = flat[start[active] + depth], node[active]
        new = np.ones(len(active), bool)
        new[1:] = (letter[1:] != letter[:-1]) | (parent[1:] != parent[:-1])
        node[active] = size + np.cumsum(new) - 1
        letters.append(letter[new])
        parents.append(parent[new])
        size, depth = size + int(new.sum()), depth + 1
        done = active[length[active] == depth]
        ends.append(np.stack([node[done], counts[done], done]))
    ended = np.concatenate(ends, axis=1)
    children = np.bincount(np.concatenate(parents), minlength=size) if parents else np.zeros(1, np.int64)
    parts = [np.concatenate([[0], *letters]).astype(np.uint32), children.astype(np.uint32), np.diff(ended[0], prepend=0).astype(np.uint32), ended[1].astype(np.int64), ended[2].astype(np.uint32)]
    return zlib.compress(np.array([size, ended.shape[1]], np.int64).tobytes() + b"".join(p.tobytes() for p in parts), 1)


def unpack(packed: bytes) -> Trie:
    raw = zlib.decompress(packed)
    size, ended = np.frombuffer(raw, np.int64, 2)
    at, parts = 16, []
    for kind, n in ((np.uint32, size), (np.uint32, size), (np.uint32, ended), (np.int64, ended), (np.uint32, ended)):
        parts.append(np.frombuffer(raw, kind, n, at))
        at += parts[-1].nbytes
    letters, code = np.unique(parts[0][1:], return_inverse=True)
    children = parts[1].astype(np.int64)
    node = np.cumsum(parts[2].astype(np.int64))
    count, place = np.zeros(size, np.int64), np.zeros(size, np.int64)
    count[node], place[node] = parts[3], parts[4]
    keys = np.repeat(np.arange(size), children) * len(letters) + code
    return Trie(letters, keys, 1 + np.cumsum(children) - children, children, count, place)


def neighbours(trie: Trie, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of a word (its index) and a word of the trie (its node) at distance exactly one, once.

    The automata of all words go down the trie together. A branch that has its error is followed to its end before the
    next letter of the path without error. One spelling is reached in one way: of equal letters the last is the one that is
    left out, and a letter is put in only before a different one or at the end.
    """
    flat, start, length = spelled(words)
    letters = np.append(trie.letters, np.uint32(0xFFFFFFFF))  # no code point
    at = np.searchsorted(trie.letters, flat)
    code = np.append(np.where(letters[at] == flat, at, -1), -1)
    accepted: list[tuple[np.ndarray, np.ndarray]] = []

    def follow(word: np.ndarray, node: np.ndarray, place: np.ndarray) -> None:
        while len(word):
            over = place == length[word]
            ends = over & (trie.count[node] > 0)
            accepted.append((word[ends], node[ends]))
            word, node, place = word[~over], node[~over], place[~over]
            node = trie.child(node, code[start[word] + place])
            word, place, node = word[node > 0], place[node > 0] + 1, node[node > 0]

    word, node, depth = np.arange(len(words)), np.zeros(len(words), np.int64), 0
    while len(word):
        inside = length[word] > depth
        here = start[word] + np.where(inside, depth, 0)
        letter = np.where(inside, code[here], -1)
        spells = np.where(inside, flat[np.minimum(here, max(len(flat) - 1, 0))].astype(np.int64), -1) if len(flat) else np.full(len(word), -1)
        # one letter of the word is left out
        last = length[word] == depth + 1
        following = flat[np.minimum(here + 1, max(len(flat) - 1, 0))] if len(flat) else np.zeros(len(word))
        out = inside & (last | (following != spells))
        follow(word[out], node[out], np.full(int(out.sum()), depth + 1))
        # another letter is put in or takes a letter's place
        many = trie.children[node]
        which = np.repeat(np.arange(len(word)), many)
        to = np.repeat(trie.first[node], many) + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        other = trie.keys[to - 1] % len(trie.letters) != letter[which]
        which, to = which[other], to[other]
        follow(word[which], to, np.full(len(which), depth))
        swap = inside[which]
        follow(word[which[swap]], to[swap], np.full(int(swap.sum()), depth + 1))
        word, node = word[inside], trie.child(node[inside], letter[inside])
        word, node, depth = word[node > 0], node[node > 0], depth + 1
    return tuple(np.concatenate(x) for x in zip(*accepted, strict=True)) if accepted else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def best_forms(tries: list[Trie], words: list[str]) -> tuple[np.ndarray, np.ndarray, list[str | None]]:
    """Of each word: how many words of the tries are near, and the count and spelling of the most frequent of them, the
    least in code-point order on ties."""
    near, most, best = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [None] * len(words)
    for trie in tries:
        for low in range(0, len(words), AUTOMATA):
            word, node = neighbours(trie, words[low : low + AUTOMATA])
            if not len(word):
                continue
            turn = np.lexsort((trie.place[node], -trie.count[node], word))
            word, node = word[turn], node[turn]
            top = np.ones(len(word), bool)
            top[1:] = word[1:] != word[:-1]
            near[low : low + AUTOMATA] += np.bincount(word, minlength=min(AUTOMATA, len(words) - low))
            for w, v in zip((word[top] + low).tolist(), node[top].tolist(), strict=True):
                n = trie.count[v]
                if n >= most[w]:
                    spelling = trie.word(v)
                    if n > most[w] or spelling < best[w]:
                        most[w], best[w] = n, spelling
    return near, most, best


def shards(words: DataFrame, count: int) -> DataFrame:
    """Packed tries of sorted words (word, n): trie, bytes. A shard's words are neighbours in order, so most automata end at
    the first letters of most shards."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        counts: list[int] = []
        chars = 0
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                if held and (len(held) == SHARD_WORDS or chars + len(word) > SHARD_CHARS):
                    yield row(held, counts)
                    held, counts, chars = [], [], 0
                held.append(word)
                counts.append(n)
                chars += len(word)
        if held:
            yield row(held, counts)

    def row(held: list[str], counts: list[int]) -> pa.RecordBatch:
        trie = pack(held, np.array(counts, np.int64))
        return pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([trie], pa.binary()), pa.array([len(trie)], pa.int64())], ["least", "trie", "bytes"])

    parts = max(1, -(-count // SHARD_WORDS))
    return words.repartitionByRange(parts, "word").sortWithinPartitions("word").mapInArrow(build, "least string, trie binary, bytes long")


#: The unpacked shards of the wave that a worker was last sent.
_UNPACKED: dict[int, list[Trie]] = {}


def near_forms(words: DataFrame) -> DataFrame:
    """word, near, most and best of each word (word, n) that has near words among all, for each wave of shards.

    Shards are sent to all workers in waves of WAVE_BYTES (or one shard, if that is larger); a wave's results are staged
    before the next is sent, so neither the driver nor a worker holds more than a wave, whatever the vocabulary.
    """
    spark, count = words.sparkSession, words.count()
    made = staged(shards(words, count), "shards")
    waves, held = [[]], 0
    for least, size in made.select("least", "bytes").orderBy("least").toLocalIterator():  # names of shards, one for SHARD_WORDS words
        if waves[-1] and held + size > WAVE_BYTES:
            waves.append([])
            held = 0
        waves[-1].append(least)
        held += size
    found, parts = None, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // TASK_WORDS))
    asked = words.select("word").repartitionByRange(parts, "word")  # neighbours in order walk the same nodes
    for wave in waves:
        chosen = made.where(F.col("least").between(wave[0], wave[-1])) if wave else made
        sent = spark.sparkContext.broadcast([bytes(r.trie) for r in chosen.select("trie").collect()])
        number = sent._jbroadcast.id() if hasattr(sent._jbroadcast, "id") else id(sent)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, number=number) -> Iterator[pa.RecordBatch]:
            if number not in _UNPACKED:
                _UNPACKED.clear()
                _UNPACKED[number] = [unpack(t) for t in sent.value]
            for batch in batches:
                spellings = batch.column("word").to_pylist()
                near, most, best = best_forms(_UNPACKED[number], spellings)
                some = np.nonzero(near)[0]
                yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(some)), pa.array(near[some]), pa.array(most[some]), pa.array([best[i] for i in some], pa.string())], ["word", "near", "most", "best"])

        part = staged(asked.mapInArrow(run, "word string, near long, most long, best string"), "near")
        sent.destroy()
        found = part if found is None else found.unionByName(part)
    return found


def roots(links: DataFrame) -> DataFrame:
    """word and root: the last word that forms (word, form) lead to. Each round doubles how far a word has come; a form
    is more frequent than its word, so no word leads back to itself."""
    state = staged(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not moved.where("moved").limit(1).count():
            return moved.select("word", "root")
        state = moved.drop("moved")


def spelling_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``words`` (word, n; each word once) with form, root, n_near and form_n.

    Near words differ by exactly one inserted, deleted or replaced code point. ``form``: the most frequent near word, the
    least in code-point order on ties, if it is at least ``ratio`` (over 1) times as frequent; else null, as is form_n.
    ``root``: the last word that forms lead to, the word itself if it has none. Words of any length and script; null words
    are left out; an empty table gives an empty one.
    """
    words = staged(words.where(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n")), "words")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("near", "long"), ("most", "long"), ("best", "string"))]
    parts = words.select("word", "n", *none).unionByName(near_forms(words).withColumn("n", F.lit(None).cast("long")))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("most")).alias("m"), "best"))).alias("b")
    met = parts.groupBy("word").agg(F.max("n").alias("n"), F.coalesce(F.sum("near"), F.lit(0)).alias("n_near"), best)
    often = -F.col("b.m") >= ratio * F.col("n")
    met = staged(met.select("word", "n", "n_near", F.when(often, F.col("b.best")).alias("form"), F.when(often, -F.col("b.m")).alias("form_n")), "forms")
    last = roots(met.where("form IS NOT NULL"))
    return met.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def word_counts(df: DataFrame, *, text: str = "text", letters: str = r"A-Za-zÀ-ÿ", least_length: int = 7, least_count: int = 2, change: Callable[[Column], Column] = lambda w: w) -> DataFrame:
    """word and n: how often each maximal run of ``letters``, A-Z lower-cased and then changed by ``change`` (which may use all
    columns and must not lengthen words), occurs in all texts. Shorter and rarer words are left out. Null texts have none."""
    runs = F.regexp_extract_all(F.col(text), F.lit(f"([{letters}]+)"), F.lit(1))
    long = df.withColumn("_run", F.explode(F.filter(runs, lambda r: F.length(r) >= least_length)))
    words = long.select(change(ascii_lower(F.col("_run"))).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def slips(doc_id: str, every: int = 31) -> Callable[[Column], Column]:
    """Leaves out one code point of a run if ``every`` divides the CRC-32 of its document and spelling; none without a document."""

    def change(run: Column) -> Column:
        h = F.crc32(F.concat(F.col(doc_id).cast("string"), F.lit(":"), run).cast("binary"))
        at = F.pmod(h, F.length(run)).cast("int")
        return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)

    return change


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_groups(word_counts(docs, change=slips("doc_id")))


QUERIES = {"op12_spelling_variants": op12_spelling_variants}

_RUNS = "SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) AS r WHERE length(run) >= 7 GROUP BY ALL"
ORACLE = {
    "op12_spelling_variants": f"""WITH RECURSIVE {crc32_sql("concat(CAST(doc_id AS VARCHAR), ':', run)", _RUNS)},
slipped AS (SELECT n, CASE WHEN doc_id IS NOT NULL AND crc % 31 = 0 THEN concat(substr(run, 1, crc % length(run)), substr(run, crc % length(run) + 2)) ELSE run END AS word FROM crcs),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (SELECT word, i, concat(substr(word, 1, i), substr(word, i + 2)) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words) AS x),
near AS (SELECT l.word, w.word AS other FROM less AS l JOIN words AS w ON w.word = l.rest UNION SELECT w.word, l.word FROM less AS l JOIN words AS w ON w.word = l.rest
  UNION SELECT a.word, b.word FROM less AS a JOIN less AS b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word),
ranked AS (SELECT x.word, o.word AS other, o.n, count(*) OVER (PARTITION BY x.word) AS n_near, row_number() OVER (PARTITION BY x.word ORDER BY o.n DESC, o.word) AS r FROM near AS x JOIN words AS o ON o.word = x.other),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 10 * w.n THEN other END AS form, CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n FROM words AS w LEFT JOIN ranked AS r ON r.word = w.word AND r.r = 1),
steps(word, top) AS (SELECT word, word FROM forms UNION ALL SELECT s.word, f.form FROM steps AS s JOIN forms AS f ON f.word = s.top WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.top AS root, f.n, f.n_near, f.form_n FROM forms AS f JOIN steps AS s ON s.word = f.word JOIN forms AS g ON g.word = s.top WHERE g.form IS NULL"""
}
