"""Session helpers: size-checked broadcasts and lineage cuts that survive lost executors."""

from __future__ import annotations

import gc
import tempfile
import uuid
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_CHARS = 64_000_000
COMPACT_BYTES = 32 << 20
# for stored texts, which it makes smaller than the default codec does
CODEC = "zstd"


_local_folder: list[str] = []


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the session's ``spark.checkpoint.dir``.

    Where that is unset, a local master gets a temporary folder of its own; on a cluster a
    machine-local folder would be invisible to the other executors, so the setting has to be there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _local_folder:
            _local_folder.append(tempfile.mkdtemp(prefix="articlespark-"))
        base = _local_folder[0]
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for scratch in _scratches:
        scratch.paths.append(path)
    return path


class Scratch:
    """The shared paths handed out inside its ``with`` blocks, so that what was written to them can go once it has been used."""

    def __init__(self):
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        _scratches.append(self)
        return self

    def __exit__(self, *_) -> None:
        _scratches.remove(self)

    def free(self, spark: SparkSession) -> None:
        """Delete it all. Frames that still read from it can no longer be computed."""
        while self.paths:
            delete(spark, self.paths.pop())


_scratches: list[Scratch] = []


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table. ``codec`` is that of the session if it is not given."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more, everything computed from them being written itself."""
    for table in tables:
        delete(table.sparkSession, table.written_to)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs, which otherwise stay until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def compact(df: DataFrame, label: str, task_bytes: int = COMPACT_BYTES, tasks: int = 1) -> DataFrame:
    """Write ``df`` and read it in no more partitions than its files fill, or ``tasks`` if these are more: an iterative learner runs a job
    per step, and a task per nearly empty partition would be most of its time. What computes ``df`` keeps its own partitions."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return filled(spark, path, df.schema, task_bytes, tasks)


def filled(spark: SparkSession, path: str, schema: StructType, task_bytes: int = COMPACT_BYTES, tasks: int = 1) -> DataFrame:
    """A stored table in no more partitions than its files fill, or ``tasks`` if these are more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return spark.read.schema(schema).parquet(path).coalesce(max(tasks, ceil(size / task_bytes)))


def small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
          max_chars: int = BROADCAST_MAX_CHARS) -> DataFrame:
    """Mark ``df`` for broadcast after measuring it; a larger table is returned unmarked, and the
    join then shuffles (with adaptive skew splitting)."""
    size = (df.limit(max_rows + 1)
            .select(F.length(F.struct(*df.columns).cast("string")).alias("chars"))
            .agg(F.count("*").alias("n"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"))
            .first())
    if size["n"] <= max_rows and size["chars"] <= max_chars:
        return F.broadcast(df)
    return df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores where the input has too few splits for them, as with one small file of
    long texts. A table with at least a split per core is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
