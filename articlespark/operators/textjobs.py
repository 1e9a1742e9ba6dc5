"""Text jobs against lexicon tables: lemmas, sentiment, themes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..runtime import small


def with_lemmas(df: DataFrame, id_col: str, tokens: Column, lemmas: DataFrame, name: str = "_lemmas") -> DataFrame:
    """Add a map from the forms in ``tokens`` that change to their lemmas, from a (form, lemma) table of any size.

    Only an article's distinct words meet the table, and only those that change are shuffled; the map
    holds no more than the article's own words. Of several lemmas of a form the smallest counts. An
    article without such words, or without an id, gets null."""
    forms = (lemmas.dropna(subset=["form"]).groupBy("form").agg(F.min("lemma").alias("lemma"))
             .filter("lemma <> form"))
    changed = df.select(id_col, F.explode(F.array_distinct(tokens)).alias("form")).join(small(forms), "form")
    maps = changed.groupBy(id_col).agg(F.map_from_entries(F.collect_set(F.struct("form", "lemma"))).alias(name))
    return df.join(maps, id_col, "left")


def lemmatize_join(df: DataFrame, id_col: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """Map a token array through a (form, lemma) table of any size, keeping the token order."""
    mapped = tx.replace_words(F.col(tokens), F.col("_lemmas"))
    return (with_lemmas(df, id_col, F.col(tokens), lemmas)
            .withColumn(tokens, F.coalesce(mapped, F.array().cast("array<string>"))).drop("_lemmas"))


def lexicon_scores(df: DataFrame, id_col: str, texts: Mapping[str, Column], lexicon: DataFrame) -> DataFrame:
    """Mean polarity and subjectivity of the lexicon words in each text.

    ``texts`` maps a prefix to a text column; ``<prefix>_polarity`` and ``<prefix>_subjectivity``
    are added. No hit scores 0.0, a null text scores null. All texts share one pass; after the
    broadcast join one row of sums per article and task is shuffled, never the words.
    """
    tagged = F.array(*[F.struct(F.lit(prefix).alias("src"), tx.words(F.lower(c)).alias("words")) for prefix, c in texts.items()])
    entries = (lexicon.dropna(subset=["word"]).groupBy("word")
               .agg(F.avg("polarity").alias("polarity"), F.avg("subjectivity").alias("subjectivity")))
    # a row per text first, so that a word's row holds the word itself and no struct is made for it
    hits = (df.select(id_col, F.explode(tagged).alias("t")).select(id_col, "t.src", "t.words")
            .select(id_col, "src", F.explode("words").alias("word"))
            .join(small(entries), "word"))
    sums = hits.groupBy(id_col).agg(*[
        F.avg(F.when(F.col("src") == prefix, F.col(m))).alias(f"_{prefix}_{m}")
        for prefix in texts for m in ("polarity", "subjectivity")])
    out = df.join(sums, id_col, "left")
    for prefix, c in texts.items():
        for m in ("polarity", "subjectivity"):
            score = F.when(c.isNotNull(), F.coalesce(F.col(f"_{prefix}_{m}"), F.lit(0.0)))
            out = out.withColumn(f"{prefix}_{m}", score)
    return out.drop(*[f"_{prefix}_{m}" for prefix in texts for m in ("polarity", "subjectivity")])


def themes(df: DataFrame, text: str, nouns: DataFrame, year: str | None = "year") -> DataFrame:
    """Counted noun lemmas (theme, count), per year if there is one, most frequent first.

    Words are counted before the lexicon join, so frequent words are one row each."""
    keys = [year] if year else []
    kept = df.dropna(subset=keys) if keys else df
    counted = (kept.select(*keys, F.explode(tx.word_tokens(F.col(text))).alias("form"))
               .groupBy(*keys, "form").agg(F.count("*").alias("_n")))
    forms = nouns.dropna(subset=["form"]).groupBy("form").agg(F.min("lemma").alias("theme"))
    return (counted.join(small(forms), "form")
            .groupBy(*keys, "theme").agg(F.sum("_n").alias("count"))
            .orderBy(*keys, F.desc("count"), "theme"))
