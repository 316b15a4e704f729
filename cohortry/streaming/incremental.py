"""Metric fragments as they arrive: each trigger takes the new files and upserts them by sample and metric."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.sources.text_tables import EAV
from cohortry.staging import staged


def append_fragments(spark: SparkSession, arriving: str, table: str, checkpoint: str) -> None:
    """Append all files that are new in ``arriving`` to the Parquet table, then stop. The checkpoint makes each file count once;
    each row keeps the time at which its file was written, and its batch."""
    fragments = spark.readStream.option("sep", "\t").option("header", True).option("nullValue", "NA").schema(EAV).csv(arriving)
    timed = fragments.select("*", F.col("_metadata.file_modification_time").alias("written"), F.col("_metadata.file_path").alias("file"))
    timed.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest(table: DataFrame) -> DataFrame:
    """One row for each sample and metric: the value of the file written last, by name on ties. Within a file two values of a
    metric are left to the conflict check, which ``conflicts`` does."""
    newest = F.max_by("value", F.struct("written", "file", "value"))
    return table.groupBy("sample", "metric").agg(newest.alias("value"))


def conflicts(table: DataFrame) -> DataFrame:
    """Metrics that one file gives two values."""
    return table.groupBy("sample", "metric", "file").agg(F.min("value").alias("low"), F.max("value").alias("high")).where("low <> high")


#: Parts that the stored table is dealt to by sample; a batch rewrites only those that it has samples of.
PARTS = 64


def upsert_fragments(spark: SparkSession, arriving: str, table: str, checkpoint: str, parts: int = PARTS) -> None:
    """Take all new files of ``arriving`` into the stored table of latest values, then stop.

    The table has one row for each sample and metric, with the time and file that its value comes from; a batch is reduced,
    met with the stored rows of the parts that it touches, and these parts alone are written anew, as one file each, so the table
    is compact and no history is read. A value replaces another if its file was written later (by name on ties). To apply a batch
    twice changes nothing, so a batch that was cut off is simply applied again. ``parts`` must stay what it was at first.
    """
    key, value = ["sample", "metric"], F.struct("written", "file", "value")
    part = F.pmod(F.xxhash64("sample"), F.lit(parts)).cast("int").alias("part")

    def merge(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        fresh = staged(batch.groupBy(*key).agg(F.max(value).alias("v")).select(*key, "v", part), "fragments")
        touched = [r.part for r in fresh.select("part").distinct().collect()]  # at most as many as there are parts
        if not touched:
            return
        if _there(session, table):
            stored = session.read.parquet(table).where(F.col("part").isin(touched))
            fresh = fresh.unionByName(stored.select(*key, value.alias("v"), "part"))
        merged = staged(fresh.groupBy(*key, "part").agg(F.max("v").alias("v")).select(*key, "v.*", "part"), "merged")
        merged.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(table)

    fragments = spark.readStream.option("sep", "\t").option("header", True).option("nullValue", "NA").schema(EAV).csv(arriving)
    timed = fragments.select("*", F.col("_metadata.file_modification_time").alias("written"), F.col("_metadata.file_path").alias("file"))
    timed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _there(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
