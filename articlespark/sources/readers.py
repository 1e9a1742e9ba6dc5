"""Readers with declared schemas."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

ZIP_BATCH_ROWS = 5_000


def read_csv(spark: SparkSession, path, schema: str | T.StructType) -> DataFrame:
    """CSV with header and quoted multi-line fields, as the article files have them.

    An empty field is null, quoted or not."""
    df = (spark.read.schema(schema).option("header", True).option("multiLine", True)
          .option("quote", '"').option("escape", '"').option("enforceSchema", False).csv(path))
    return df.select(*[F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema])


def read_raw_articles(spark: SparkSession, true_path, fake_path, test_path,
                      extra_test_paths: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(fake, true, test)``; further test files are appended with missing columns null."""
    fake = read_csv(spark, fake_path, schemas.RAW_ARTICLES)
    true = read_csv(spark, true_path, schemas.RAW_ARTICLES)
    test = read_csv(spark, test_path, f"{schemas.RAW_ARTICLES}, {schemas.RAW_TEST_EXTRA}")
    for path in extra_test_paths:
        test = test.unionByName(read_known(spark, path, f"{schemas.RAW_ARTICLES}, {schemas.RAW_TEST_EXTRA}"), allowMissingColumns=True)
    return fake, true, test


def read_known(spark: SparkSession, path, schema: str) -> DataFrame:
    """The columns of a CSV file that the schema knows, under its types; those of the schema that the file lacks are left out."""
    known = {f.name: f for f in T.StructType.fromDDL(schema)}
    header = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path).columns
    fields = [known.get(name, T.StructField(name, T.StringType())) for name in header]
    return read_csv(spark, path, T.StructType(fields)).select(*[f"`{name}`" for name in header if name in known])


def read_zipped_csv(spark: SparkSession, path, columns: Sequence[str]) -> DataFrame:
    """String columns of the CSV members of ZIP archives, one task per archive.

    ZIP cannot be split, so this is meant for one ingest into Parquet. Members are decompressed
    and parsed as a stream; a task holds the compressed archive and one batch of rows.
    """
    names = list(columns)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(2 ** 31 - 1)
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        if not member.lower().endswith(".csv"):
                            continue
                        with archive.open(member) as raw:
                            reader = csv.DictReader(io.TextIOWrapper(raw, encoding="utf-8", newline=""))
                            rows = []
                            for row in reader:
                                rows.append([row.get(c) or None for c in names])
                                if len(rows) >= ZIP_BATCH_ROWS:
                                    yield pd.DataFrame(rows, columns=names, dtype=object)
                                    rows = []
                            if rows:
                                yield pd.DataFrame(rows, columns=names, dtype=object)

    archives = spark.read.format("binaryFile").load(path).select("content")
    return archives.mapInPandas(unpack, schema)


def read_typed(spark: SparkSession, path, schema: str, columns: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Some columns under declared types; Parquet reads no others."""
    if fmt == "csv":
        return read_csv(spark, path, schema).select(*columns)
    return spark.read.schema(schema).format(fmt).load(path).select(*columns)


def read_wordcloud(spark: SparkSession, path, columns: Sequence[str] = ("label", "text")) -> DataFrame:
    """Columns of the word-cloud table."""
    return spark.read.schema(schemas.WORDCLOUD_TEXT).parquet(path).select(*columns)


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def require_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"missing expected columns: {missing}")
    return df


def numbered(df: DataFrame, name: str = "ord") -> DataFrame:
    """Add the place of each row in the files it was read from, as a struct that sorts in file order: by file name, part of the file,
    and row. ``df`` is a table of files, or columns of one; however its files are dealt to tasks, the order is theirs."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"),
                     F.monotonically_increasing_id().alias("row"))
    return df.select("*", place.alias(name))
