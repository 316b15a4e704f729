"""Substring deduplication by sliding sentence spans: hash runs of consecutive sentences, join them globally, and remove
the sentences of every repeated run but its first."""

from __future__ import annotations

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortry.llm.common import small, staged, table

#: A sentence ends at a closing mark, with the quotes and brackets that follow it, before white space, or at a line feed.
BOUNDARY = regex.compile(r"""(?<=[.!?…。！？]["'”’»)\]]*+)\s+|\s*\n\s*|(?<=[。！？])""")
#: A run has the fewest consecutive sentences, RUN_SENTENCES at least, that hold RUN_WORDS words: from each sentence on and
#: up to each sentence. Every shared passage of whole sentences that has so many of both is covered wholly by shared runs.
RUN_SENTENCES, RUN_WORDS = 2, 20
#: Parts that the rows of one run are dealt to when they are joined.
SALTS = 8


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence with a word; what follows a sentence up to the next belongs to it."""
    starts = [0, *(m.end() for m in BOUNDARY.finditer(text) if m.end())]
    found: list[tuple[int, int]] = []
    for start, end in zip(starts, [*starts[1:], len(text)], strict=True):
        if text[start:end].strip():
            found.append((start, end))
        elif found:
            found[-1] = (found[-1][0], end)
    return found


def runs_of(text: str, run_words: int, least: int = RUN_SENTENCES) -> list[tuple[int, int, int, int]]:
    """Each run once: two halves of the 128-bit hash of its words, and its start and end in code points. At most two runs
    for each sentence of the text are held."""
    places = sentences(text)
    plain = [" ".join(text[a:b].split()) for a, b in places]
    sizes = [s.count(" ") + 1 for s in plain]
    n, found = len(places), set()
    end = total = 0
    for start in range(n):
        while end < n and (total < run_words or end - start < least):
            total += sizes[end]
            end += 1
        if total < run_words or end - start < least:
            break
        found.add((start, end))
        total -= sizes[start]
    start, total = n, 0
    for end in range(n, 0, -1):
        while start > 0 and (total < run_words or end - start < least):
            start -= 1
            total += sizes[start]
        if total < run_words or end - start < least:
            break
        found.add((start, end))
        total -= sizes[end - 1]
    out = []
    for a, b in sorted(found):
        digest = xxhash.xxh3_128_intdigest(" ".join(plain[a:b]).encode("utf-8", "surrogatepass"))
        out.append(((digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63), places[a][0], places[b - 1][1]))
    return out


def repeated_spans(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", run_words: int = RUN_WORDS) -> DataFrame:
    """doc_id, digest (of the text) and spans (sorted start, end) of the runs that stood earlier, by id, then place.

    Rows of the same id and text count as one document. The first pass counts runs by half of the hash, the second keeps
    the rows of repeated ones; only these are grouped by the whole hash. Both joins deal the rows of a run to SALTS parts.
    """
    salt = F.pmod(F.xxhash64("digest", "start"), F.lit(SALTS)).cast("int").alias("salt")
    salted = lambda few: few.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))

    @arrow_udf("array<struct<h:bigint,k:bigint,start:int,end:int>>")
    def runs(texts: pa.Array) -> pa.Array:
        h, k, starts, ends, offsets = [], [], [], [], [0]
        for t in texts:
            for a, b, start, end in runs_of(t.as_py(), run_words):
                h.append(a)
                k.append(b)
                starts.append(start)
                ends.append(end)
            offsets.append(len(h))
        rows = pa.StructArray.from_arrays([pa.array(h, pa.int64()), pa.array(k, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["h", "k", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    made = df.where(F.length(text) > 0).select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("digest"), F.explode(runs(F.col(text))).alias("r"))
    made = staged(made.select("doc_id", "digest", "r.*"), "runs")
    often = made.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    again = staged(made.withColumn("salt", salt).join(salted(often), ["h", "salt"]).drop("salt"), "again")
    place = F.struct("doc_id", "digest", "start", "end")
    first = again.groupBy("h", "k").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(~F.col("first").eqNullSafe(F.col("last"))).select("h", "k", "first")
    later = again.withColumn("salt", salt).join(salted(first), ["h", "k", "salt"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))


def without(text: Column, spans: Column) -> Column:
    """The text less its spans."""

    def step(state: Column, s: Column) -> Column:
        between = F.when(s["start"] > state["at"], F.substring(text, state["at"] + 1, s["start"] - state["at"])).otherwise("")
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], between).alias("out"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def merged(spans: str) -> Column:
    """Sorted spans, those that touch or overlap as one."""

    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (s["start"] <= F.element_at(done, F.greatest(F.size(done), F.lit(1)))["end"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), step)


def span_dedup(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", run_words: int = RUN_WORDS) -> DataFrame:
    """``df`` with the repeated sentences taken out of ``text``, and ``removed``, an array of start and end in code points
    of what was taken out.

    A sentence goes if it is in a run of RUN_SENTENCES sentences and ``run_words`` words at least that stood earlier: in a document of a lesser id, or
    earlier in its own. Runs are equal if their words are. Shorter texts have no runs. Null texts stay null, with nothing
    removed; null ids come before all others. Rows of the same id and text are treated alike. Other columns stay; one
    named ``removed`` is replaced. An empty table gives an empty one.
    """
    spans = staged(repeated_spans(df, text=text, doc_id=doc_id, run_words=run_words).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), merged("spans").alias("removed")), "spans")
    spans = F.broadcast(spans) if small(spans) else spans
    held = df.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("whole"))
    met = held.join(spans, F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("whole") == F.col("_digest")), "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    met = met.select("row", "whole", F.coalesce("removed", none).alias("removed"))
    less = F.when(F.size("removed") > 0, without(F.col("whole"), F.col("removed"))).otherwise(F.col("whole"))
    return met.select(*[less.alias(c) if c == text else F.col("row")[c].alias(c) for c in df.columns if c != "removed"], "removed")


def op10_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = F.aggregate("removed", F.lit(0), lambda total, s: total + s["end"] - s["start"])
    return span_dedup(docs).select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), gone.cast("long").alias("n_removed"), F.size("removed").cast("long").alias("n_spans"))


QUERIES = {"op10_span_dedup": op10_span_dedup}
