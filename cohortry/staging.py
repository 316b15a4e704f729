"""Tables that are written once and read back, and the measure of what may be broadcast."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only after it was measured to have no more rows and bytes (as JSON) than these.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only where none is configured and all run on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="cohortry-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and the rows outlive executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` was measured to have at most ``limit`` rows and BROADCAST_BYTES bytes."""
    size = F.octet_length(F.to_json(F.struct("*")))
    rows, held = df.limit(limit + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    return rows <= limit and (held or 0) <= BROADCAST_BYTES
