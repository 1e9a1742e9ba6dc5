"""Projections and filters over article rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx

# Display names and realness scores, cut-off dates and length caps.
REAL_NAME, DUBIOUS_NAME = "True News", "Fake News"
REALNESS = {0: 1, 1: 5}
MAP_FROM = date(2014, 1, 1)
DAILY_FROM = date(2015, 1, 1)
VALID_FROM = date(2001, 1, 1)
MAX_TITLE_LENGTH = 1000
MAX_TEXT_LENGTH = 25000
ID_OFFSET = 100_000


def label_names(real_label: int = 1) -> dict[int, str]:
    return {real_label: REAL_NAME, 1 - real_label: DUBIOUS_NAME}


def named_filters(real_label: int = 1) -> dict[str, Column]:
    return {"locations_ftr": F.col("ignore") == 1, "fake_news_ftr": F.col("label") == 1 - real_label,
            "true_news_ftr": F.col("label") == real_label, "validdates_ftr": F.col("date") > F.lit(VALID_FROM)}


def tag_origin(df: DataFrame, file: str, label: int | None = None) -> DataFrame:
    out = df.withColumn("file", F.lit(file))
    return out if label is None else out.withColumn("label", F.lit(label))


def offset_ids(df: DataFrame, id_col: str, offset: int = ID_OFFSET) -> DataFrame:
    return df.withColumn(id_col, F.col(id_col) + F.lit(offset))


def text_only_source(df: DataFrame, label: int, index_col: str | None = None) -> DataFrame:
    """Complete a source that has texts only: title from the first sentence, fixed subject and date."""
    if index_col:
        df = df.drop(index_col)
    return df.withColumns({
        "title": tx.first_sentence(F.col("text")),
        "subject": F.lit("UNKNOWN"),
        "date": F.lit("None"),
        "label": F.lit(label),
    })


def backfill_title(df: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    return df.withColumn(title, F.coalesce(F.col(title), tx.first_sentence(F.col(text))))


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def drop_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [~tx.is_blank(F.col(c)) for c in cols]))


def empty_text_to_title(df: DataFrame, text: str = "cleaned_text", title: str = "title") -> DataFrame:
    filled = F.when(F.length(text) == 0, F.col(title)).otherwise(F.col(text))
    return df.withColumn(text, filled).withColumn("text_length", F.length(text))


def fill_defaults(df: DataFrame, null_defaults: Mapping[str, object],
                  empty_too: Sequence[str] = ()) -> DataFrame:
    """Nulls (and empty strings for the columns in ``empty_too``) become the given defaults."""
    exprs = {}
    for name, value in null_defaults.items():
        c = F.col(name)
        missing = c.isNull() | (c == "") if name in empty_too else c.isNull()
        exprs[name] = F.when(missing, F.lit(value)).otherwise(c)
    return df.withColumns(exprs)


def fill_region_hierarchy(df: DataFrame) -> DataFrame:
    """Subcontinent from continent, then country from subcontinent, then state from country."""
    sub = F.coalesce("subcontinent", "continent")
    country = F.coalesce(F.col("country"), sub)
    return df.withColumns({"subcontinent": sub, "country": country,
                           "state": F.coalesce(F.col("state"), country)})


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def remap(c: Column, table: Mapping) -> Column:
    """Small literal lookup; values not in the table become null."""
    out = None
    for key, value in table.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out


def filter_named(df: DataFrame, name: str, real_label: int = 1) -> DataFrame:
    return df.filter(named_filters(real_label)[name])


def matching_filters(df: DataFrame, keep: Sequence[str], real_label: int = 1, name: str = "filter") -> DataFrame:
    """(``keep``, filter): a row per named filter that a row passes, all from one pass."""
    passed = F.array(*[F.when(condition, F.lit(n)) for n, condition in named_filters(real_label).items()])
    return df.select(*keep, F.explode(F.array_compact(passed)).alias(name))


def filter_from_date(df: DataFrame, col: str, start: date) -> DataFrame:
    return df.filter(F.col(col) >= F.lit(start))


def filter_date_range(df: DataFrame, col: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Rows between two dates; an open end is the data's own, so it only excludes null dates."""
    keep = F.col(col).isNotNull()
    if start is not None:
        keep = keep & (F.col(col) >= F.lit(start))
    if end is not None:
        keep = keep & (F.col(col) <= F.lit(end))
    return df.filter(keep)


def filter_equal(df: DataFrame, **values) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in values.items()]))


def null_near_zero(df: DataFrame, cols: Sequence[str], threshold: float) -> DataFrame:
    """Values closer to zero than the threshold become null; rows with all of them null go."""
    out = df.withColumns({c: F.when(F.abs(c) >= threshold, F.col(c)) for c in cols})
    return out.dropna(how="all", subset=list(cols))


def cap_lengths(df: DataFrame) -> DataFrame:
    return df.filter((F.col("title_length") < MAX_TITLE_LENGTH) & (F.col("text_length") < MAX_TEXT_LENGTH))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts that give null, not an error, for unreadable values."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def trim_strings(df: DataFrame) -> DataFrame:
    return df.select(*[tx.strip(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f.name) for f in df.schema])


def rows_with_null(df: DataFrame) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns]))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union by column name; columns a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
