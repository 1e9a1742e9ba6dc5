"""Saved stages: reuse a stage if it was saved, else build and save it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..runtime import CODEC

# The reuse flags from the first stage to the last.
STAGE_FLAGS = ["useprecombineddata", "usepostnlpdata", "useprelocationdata", "useprelocationenricheddata"]


class Buckets(NamedTuple):
    """How a stage is laid out: rows with the same hash of ``key`` modulo ``number`` in the same files, so that stages with the same
    layout join on the key, or group by it, without a shuffle."""
    key: str
    number: int


def resolve_flags(flags: Mapping[str, bool]) -> dict[str, bool]:
    """A later stage's reuse flag switches on those of all earlier stages."""
    out = dict(flags)
    last = max((i for i, name in enumerate(STAGE_FLAGS) if out.get(name)), default=0)
    for name in STAGE_FLAGS[:last]:
        out[name] = True
    return out


def saved(spark: SparkSession, path: str, buckets: Buckets | None = None) -> DataFrame | None:
    """The table if its writing was finished, which the marker of the output commit tells. A bucketed one is found only under the number of
    buckets that it was written with."""
    folder = _folder(path, buckets)
    marker = spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
    if not marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):
        return None
    return _bucketed(spark, folder, spark.read.parquet(folder).schema, buckets) if buckets else spark.read.parquet(folder)


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame], reuse: bool = False,
          buckets: Buckets | None = None) -> DataFrame:
    """The saved table if it may be reused and exists; else build it, save it and read it back,
    which also ends its lineage. Its files lie in ``buckets`` if they are given."""
    return _stage(spark, path, build, reuse, buckets)


def stage_over(spark: SparkSession, path: str, base: DataFrame, build: Callable[[], DataFrame], buckets: Buckets, reuse: bool = False,
               derived: Mapping[str, Column] | None = None, dropped: Sequence[str] = ()) -> DataFrame:
    """A stage that adds columns to the rows of ``base``, an earlier stage in the same buckets whose keys are unique and not null: only the
    key and what is new are saved, and the rest is read from ``base``. ``derived`` columns are made of the others as they are read,
    ``dropped`` ones of ``base`` are left out."""
    derived = derived or {}

    def added() -> DataFrame:
        built = build()
        return built.select(buckets.key, *[c for c in built.columns if c not in derived and c not in base.columns])

    own = _stage(spark, path, added, reuse, buckets)
    new = own.select(buckets.key, *[c for c in own.columns if c not in derived and c not in base.columns])
    return base.drop(*dropped).join(new, buckets.key).withColumns(dict(derived))


def _stage(spark: SparkSession, path: str, build: Callable[[], DataFrame], reuse: bool, buckets: Buckets | None) -> DataFrame:
    if reuse:
        found = saved(spark, path, buckets)
        if found is not None:
            return found
    built, folder = build(), _folder(path, buckets)
    if buckets is None:
        built.write.mode("overwrite").parquet(folder, compression=CODEC)
        return spark.read.schema(built.schema).parquet(folder)
    table = _name(folder)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    built.write.mode("overwrite").bucketBy(buckets.number, buckets.key).option("path", folder).option("compression", CODEC).format("parquet").saveAsTable(table)
    return spark.table(table)


def _folder(path: str, buckets: Buckets | None) -> str:
    return path if buckets is None else f"{path}/{buckets.key}-{buckets.number}"


def _name(folder: str) -> str:
    return f"stage_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"


def _bucketed(spark: SparkSession, folder: str, schema: StructType, buckets: Buckets) -> DataFrame:
    """The files under a table that knows their buckets, in a session that has not written them."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(folder)} ({columns}) USING parquet "
              f"CLUSTERED BY (`{buckets.key}`) INTO {buckets.number} BUCKETS LOCATION '{folder}'")
    return spark.table(_name(folder))
