"""Sinks: Parquet between stages, CSV, JSON and text for export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_csv(df: DataFrame, path: str) -> None:
    """Compressed CSV with header and quoted strings; blanks at the ends of strings are kept."""
    (df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("compression", "gzip").csv(path))


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save_by_year(df: DataFrame, path: str, year: str = "year", fmt: str = "parquet",
                 rows_per_file: int = 5_000_000, only_given: bool = True) -> None:
    """One directory per year in a single job; rows without a year are left out.

    The years of ``df`` are written anew and others stay as they are; without ``only_given`` the others go.

    Tasks get equal ranges of (year, hash of the rest), so a large year is written by as many tasks as
    its share of the rows, and a small one by one or two."""
    rest = F.xxhash64(*[c for c in df.columns if c != year])
    (df.dropna(subset=[year]).repartitionByRange(F.col(year), rest).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if only_given else "static").option("maxRecordsPerFile", rows_per_file).partitionBy(year).format(fmt).save(path))


def save_text(fragments: DataFrame, path: str, by: list[str], fragment: str = "fragment") -> None:
    """Fragments as text files joined by spaces, one directory per combination of ``by``."""
    (fragments.select(*by, F.col(fragment).alias("value")).write.mode("overwrite")
     .partitionBy(*by).option("lineSep", " ").text(path))


def save_metrics(metrics: DataFrame, path: str, fmt: str = "json") -> None:
    """A few rows of evaluation metrics as one JSON or CSV file."""
    out = metrics.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        out.option("header", True).csv(path)
    else:
        out.json(path)
