"""Term outputs: n-gram summaries, cloud weights and themes, each in one job for all years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import ngrams, sampling, textjobs
from ..sources import writers


def cloud_text(df: DataFrame, text: str = "cleaned_text", title: str | None = None,
               stopwords: Sequence[str] = (), remove_stopwords: bool = False,
               remove_punctuation: bool = False) -> DataFrame:
    """(label, text, year) of the word clouds."""
    source = F.col(text) if title is None else tx.title_and_text(F.col(title), F.col(text))
    return df.select("label", tx.cloud_clean(source, stopwords, remove_stopwords, remove_punctuation).alias("text"),
                     "year")


def save_term_tables(df: DataFrame, folder: str, nouns: DataFrame, text: str = "text", label: str = "label",
                     sizes: Sequence[int] = (1, 2, 3), stopwords: Sequence[str] = (),
                     sample_key: str | None = None) -> None:
    """The cloud text itself, summaries, cloud weights and themes below ``folder``, one directory per year.

    ``sample_key`` limits the run to the test sample of 10,000 rows."""
    if sample_key:
        df = sampling.sample_rows(df, sample_key)
    writers.save_by_year(df.select(label, text, "year"), f"{folder}/cloud_text")
    summary = ngrams.ngram_summary(df, text, label, "year", sizes, stopwords)
    writers.save_by_year(summary, f"{folder}/ngram_summary")
    written = df.sparkSession.read.parquet(f"{folder}/ngram_summary")
    writers.save_by_year(ngrams.cloud_subsets(written), f"{folder}/clouds")
    writers.save_by_year(textjobs.themes(df, text, nouns), f"{folder}/common_themes")
