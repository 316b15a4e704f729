"""Sources whose records are not lines of fields, or whose lines must all be right: depth and bedGraph tables, GenBank records,
headers of binary indexes, and digests of files of any size."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The first bytes of an index, and the numbers that follow them (window, k-mer, bucket bits, sequences, flags).
INDEX_MAGIC, INDEX_NUMBERS = b"MMI\x02", "<5I"
#: Files up to this size are one row each while they are digested; larger ones are streamed.
WHOLE_FILE = 256 << 20
#: Endings that Spark's text reader takes as compressed, so that it would not see a file's own bytes.
COMPRESSED = r"\.(gz|bz2|deflate|snappy|lz4|zst|passthrough)$"


def _refused(condition: Column, problem: str, value: Column) -> Column:
    """The value where the condition holds; any other row fails the query and is shown."""
    return F.when(F.coalesce(condition, F.lit(False)), value).otherwise(F.raise_error(F.concat(F.lit(f"{problem}: "), F.col("value"))).cast("array<string>"))


def bedgraph(spark: SparkSession, path: str) -> DataFrame:
    """contig, start, end and value. Blank lines and lines of track, browser or # are not read. Four fields, whole coordinates with
    0 <= start < end, and a finite value of 0 or more, in any notation; any other row fails the query. A file set without data rows raises."""
    lines = spark.read.text(path).withColumn("value", F.regexp_replace("value", "\r$", ""))
    lines = lines.where((F.trim("value") != "") & ~F.col("value").rlike("^(track|browser|#)"))
    if not lines.limit(1).count():
        raise ValueError(f"{path}: contains no data rows")
    f = F.split("value", "\t")
    start, end, value = F.get(f, F.lit(1)).try_cast("long"), F.get(f, F.lit(2)).try_cast("long"), F.get(f, F.lit(3)).try_cast("double")
    good = (F.size(f) == 4) & (start >= 0) & (end > start) & (value >= 0) & (value < float("inf")) & ~F.isnan(value)
    kept = lines.select(_refused(good, "not a bedGraph row", f).alias("f"))
    return kept.select(F.col("f")[0].alias("contig"), F.col("f")[1].cast("long").alias("start"), F.col("f")[2].cast("long").alias("end"), F.col("f")[3].cast("double").alias("value"))


def depth(spark: SparkSession, path: str) -> DataFrame:
    """file, contig, pos and depth of tables of three fields; rows of another number of fields go, others must be whole numbers."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", r"\s+$", "").alias("value"))
    f = F.split("value", "\t")
    good = F.get(f, F.lit(1)).rlike("^[0-9]+$") & F.get(f, F.lit(2)).rlike("^[0-9]+$")
    kept = lines.where(F.size(f) == 3).select("file", _refused(good, "not a depth row", f).alias("f"))
    return kept.select("file", F.col("f")[0].alias("contig"), F.col("f")[1].cast("long").alias("pos"), F.col("f")[2].cast("long").alias("depth"))


def depth_breadths(rows: DataFrame, length: int, levels: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Share of ``length`` positions of each file at each depth or more; a file with more or fewer positions fails the query."""
    found = rows.groupBy("file").agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col("depth") >= k).alias(f"_{k}") for k in levels])
    wrong = F.raise_error(F.concat(F.lit(f"expected {length} depth positions, observed "), F.col("_n").cast("string"), F.lit(" in "), F.col("file"))).cast("double")
    return found.select("file", *[F.when(F.col("_n") == length, F.col(f"_{k}") / F.lit(float(length))).otherwise(wrong).alias(f"breadth_{k}x") for k in levels])


def genbank(spark: SparkSession, path: str) -> DataFrame:
    """file, name (of the LOCUS line, null without one), text and sequence of each record: the bases after ORIGIN, in upper case, empty
    without it. Records end with a line of //; files are read in blocks and a record is one row, whatever its lines end with."""
    parts = spark.read.option("lineSep", "\n//").text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", r"^[\r\n]+", "").alias("text"))
    body = F.get(F.split("text", r"(?m)^ORIGIN", 2), F.lit(1))
    name = F.nullif(F.regexp_extract("text", r"(?m)^LOCUS\s+(\S+)", 1), F.lit(""))
    return parts.where(F.trim(F.regexp_replace("text", r"\s", "")) != "").select("file", name.alias("name"), "text", F.upper(F.regexp_replace(F.coalesce(body, F.lit("")), "[^acgtnACGTN]", "")).alias("sequence"))


#: What names the cluster that cannot be a decoy for itself, and what names the classes that can.
OWN_CLUSTER, DECOY_CLASSES, LEAST_CLUSTER = r"(?i)colibactin|\bclb[A-S]\b", r"(?i)\bNRPS\b|nonribosomal|polyketide|\bPKS\b|\bT1PKS\b|transAT", 5_000


def cluster_status(text: Column, length: Column) -> Column:
    """Whether a cluster may be a decoy: own_cluster, other_class, too_short or kept, in this order. All clusters are judged."""
    return F.when(text.rlike(OWN_CLUSTER), "own_cluster").when(~text.rlike(DECOY_CLASSES), "other_class").when(length < LEAST_CLUSTER, "too_short").otherwise("kept")


def _byte_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The bytes of files between line feeds, as the text reader finds them in blocks: file, size, block, id (ascending in a block) and line.
    No character is decoded."""
    rows = spark.read.option("lineSep", "\n").text(paths)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").cast("binary").alias("line"))


def index_sequences(spark: SparkSession, path: str) -> DataFrame:
    """file, window, kmer, flags, place, name and length of the sequences that an index lists at its head. The head is parsed as its bytes
    stream by; nothing after it is sent to Python. A file of another kind, one that ends within its list, and one whose list is longer
    than a block fail the query. An index without sequences has no rows."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, state = None, bytearray(), None
        for batch in batches:
            out: list[tuple] = []
            for file, size, line in zip(*(batch.column(c).to_pylist() for c in ("file", "size", "line")), strict=True):
                if file != at:
                    if state is not None:
                        raise ValueError(f"{at}: the list of sequences is cut off, or longer than a block")
                    at, held, state, seen = file, bytearray(), (None, 0, 0), 0
                if state is None:
                    continue
                held += line
                seen += len(line)
                if seen < size:
                    held += b"\n"
                    seen += 1
                numbers, place, offset = state
                if numbers is None and len(held) >= 4 + struct.calcsize(INDEX_NUMBERS):
                    if held[:4] != INDEX_MAGIC:
                        raise ValueError(f"{file}: not an index")
                    numbers, offset = struct.unpack_from(INDEX_NUMBERS, held, 4), 4 + struct.calcsize(INDEX_NUMBERS)
                while numbers and place < numbers[3] and offset < len(held) and offset + 5 + held[offset] <= len(held):
                    end = offset + 1 + held[offset]
                    out.append((file, numbers[0], numbers[1], numbers[4], place, held[offset + 1 : end].decode("utf-8", "replace"), struct.unpack_from("<I", held, end)[0]))
                    place, offset = place + 1, end + 4
                del held[:offset]
                state = None if numbers and place == numbers[3] else (numbers, place, 0)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in out], schema=schema)
        if state is not None:
            raise ValueError(f"{at}: not an index, or its list of sequences is cut off or longer than a block")

    names = ["file", "window", "kmer", "flags", "place", "name", "length"]
    schema = pa.schema([("file", pa.string()), *[(n, pa.int64()) for n in names[1:5]], ("name", pa.string()), ("length", pa.int64())])
    head = _byte_lines(spark, [path]).where("block = 0").select("file", "size", "line")
    return head.mapInArrow(parse, "file string, window long, kmer long, flags long, place long, name string, length long")


def file_digests(spark: SparkSession, path: str, whole: int = WHOLE_FILE) -> DataFrame:
    """path, bytes and sha256 of all files below a folder, of any size from one byte; Spark lists no empty files.

    Files of up to ``whole`` bytes are rows that tasks read and digest. Larger ones are read in blocks by many tasks; their pieces are
    sorted by place, spilling where they must, and one task a file streams them through the digest. A larger file whose name ends as a
    compressed one's is read whole, which ends, with an error, at 2 GB: Spark's text reader would unpack it.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    large = [r.path for r in files.where((F.col("length") > whole) & ~F.col("path").rlike(COMPRESSED)).select("path").collect()]
    kept = files.where((F.col("length") <= whole) | F.col("path").rlike(COMPRESSED))
    digests = kept.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    if not large:
        return digests

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, size, seen, digest = None, 0, 0, None

        def done() -> pa.RecordBatch:
            if seen < size:  # the file ends with a line feed
                digest.update(b"\n")
            return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([size], pa.int64()), pa.array([digest.hexdigest()])], ["path", "bytes", "sha256"])

        for batch in batches:
            for file, length, line in zip(batch.column("file").to_pylist(), batch.column("size").to_pylist(), batch.column("line"), strict=True):
                if file != at:
                    if at is not None:
                        yield done()
                    at, size, seen, digest = file, length, 0, hashlib.sha256()
                else:
                    digest.update(b"\n")
                    seen += 1
                digest.update(line.as_buffer())
                seen += len(line.as_buffer())
        if at is not None:
            yield done()

    pieces = _byte_lines(spark, [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in large]).repartition(F.col("file")).sortWithinPartitions("file", "block", "id")
    return digests.unionByName(pieces.select("file", "size", "line").mapInArrow(fold, "path string, bytes long, sha256 string"))
