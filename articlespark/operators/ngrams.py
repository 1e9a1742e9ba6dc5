"""N-gram summaries by class and year, their variants and what is derived from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lists as ls
from ..functions import measures as ms
from ..functions import text as tx
from ..runtime import small
from .aggregates import count_if, count_sums, stats_of_sums

PHRASE_MIN_TOTAL = 5
VOCAB_MIN_TOTAL = 100
NOISE_MIN_TOTAL = 10
NOISE_MIN_RELEVANCE = 0.5
REPEAT_CHUNK = 65_536
PIECE_BYTES = 1 << 20


def unigram_tokens(text: Column, stopwords: Sequence[str]) -> Column:
    """Tokens of the cleaned text: wholly alphabetic words without stopwords, cut into word runs
    of two or more characters."""
    cleaned = F.array_join(tx.contraction_tokens(text, stopwords), " ")
    return tx.word_tokens(cleaned)


def _pieces(batch: pa.RecordBatch, columns: Sequence[int]):
    """The batch in runs of rows that begin a new one every ``PIECE_BYTES`` of text."""
    length = sum(pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for i in columns)
    starts = np.unique(np.cumsum(length) // PIECE_BYTES, return_index=True)[1].tolist()
    for low, high in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(low, high - low)


def _phrase_counts(words: pa.Array, sizes: Sequence[int], weak: Sequence[str]):
    """(size, rows, phrases, counts) for each of the ascending ``sizes``: how often each row of space-separated words has each phrase
    of that many words. A phrase is the number of its opening, one word shorter, and that of its last word."""
    lists = pc.split_pattern(words, " ")
    flat = pc.list_flatten(lists)
    # no words split into one empty string
    some = pc.not_equal(flat, "")
    row = pc.list_parent_indices(lists).filter(some).to_numpy().astype(np.int64)
    coded = flat.filter(some).dictionary_encode()
    word, vocabulary = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.string())
    dull = np.asarray(pc.is_in(vocabulary, value_set=pa.array(weak, pa.string())), dtype=bool)
    number, texts, left_out = word, vocabulary, np.zeros(len(vocabulary), dtype=bool)
    at = np.arange(len(word))
    for n in range(1, max(sizes) + 1):
        if n > 1:
            # places where the row goes on for another word
            longer = at + n - 1 < len(word)
            longer[longer] = row[at[longer]] == row[at[longer] + n - 1]
            at, number = at[longer], number[longer]
            pairs, number = np.unique(number * len(vocabulary) + word[at + n - 1], return_inverse=True)
            opening, last = np.divmod(pairs, max(len(vocabulary), 1))
            texts = pc.binary_join_element_wise(texts.take(pa.array(opening)), vocabulary.take(pa.array(last)), " ")
            left_out = (dull if n == 2 else left_out)[opening] & dull[last]
        if n in sizes and len(at):
            used = ~left_out[number]
            found, cnt = np.unique(row[at[used]] * len(texts) + number[used], return_counts=True)
            article, phrase = np.divmod(found, len(texts))
            yield n, pa.array(article), texts.take(pa.array(phrase)), pa.array(cnt.astype(np.int32))


def article_terms(df: DataFrame, keep: Sequence[str], tokens: Mapping[int, Column], weak: Sequence[str] = ()) -> DataFrame:
    """One row per article, n-gram size and distinct term with its count in that article, from the words that the terms
    of each size are made of; words hold no spaces. Phrases made of ``weak`` words only are left out.

    Counting happens inside the article's row, so article-level counts need no shuffle.
    """
    # sizes that read the same words share a column
    lists = {id(c): c for c in tokens.values()}
    sizes = {len(keep) + i: sorted(n for n, c in tokens.items() if id(c) == key) for i, key in enumerate(lists)}
    rows = df.select(*keep, *[F.array_join(c, " ").alias(f"_words{i}") for i, c in enumerate(lists.values())])
    names, weak = [*keep, "ngram_size", "term", "cnt"], list(weak)

    def counted(batches):
        for batch in batches:
            for part in _pieces(batch, [*sizes]):
                for i, wanted in sizes.items():
                    for n, article, term, cnt in _phrase_counts(part.column(i), wanted, weak):
                        kept = [part.column(k).take(article) for k in range(len(names) - 3)]
                        yield pa.RecordBatch.from_arrays([*kept, pa.array(np.full(len(cnt), n, np.int32)), term, cnt], names)

    fields = [T.StructField("ngram_size", T.IntegerType()), T.StructField("term", T.StringType()), T.StructField("cnt", T.IntegerType())]
    return rows.mapInArrow(counted, T.StructType([*[rows.schema[c] for c in keep], *fields]))


def ngram_terms(df: DataFrame, keep: Sequence[str], text: str, sizes: Sequence[int] = (1, 2, 3),
                stopwords: Sequence[str] = ()) -> DataFrame:
    """Terms of each size: size 1 from the cleaned text, larger ones from the raw text with at
    most n-1 stopwords."""
    clean, raw = unigram_tokens(F.col(text), stopwords), tx.word_tokens(F.col(text))
    return article_terms(df, keep, {n: clean if n == 1 else raw for n in sizes}, stopwords)


def summarize_terms(terms: DataFrame, group: Sequence[str], label: str = "label") -> DataFrame:
    """Class counts, flags, per-article statistics and relevance per term."""
    real, dubious = F.col(label) == 1, F.col(label) == 0
    out = terms.filter(real | dubious).groupBy(*group, "ngram_size", "term").agg(
        *count_sums(F.col("cnt"), real, "real"), *count_sums(F.col("cnt"), dubious, "dubious"))
    out = out.select(*group, "ngram_size", "term", "count_real", "count_dubious", *stats_of_sums("real"), *stats_of_sums("dubious"))
    return out.withColumns({
        "is_phrase": F.col("ngram_size") > 1,
        "total_count": F.col("count_real") + F.col("count_dubious"),
        "in_real": F.col("count_real") > 0,
        "in_dubious": F.col("count_dubious") > 0,
        "relevance_score": ms.relevance(F.col("count_real"), F.col("count_dubious")),
    })


def ngram_summary(df: DataFrame, text: str = "text", label: str = "label", year: str | None = "year",
                  sizes: Sequence[int] = (1, 2, 3), stopwords: Sequence[str] = ()) -> DataFrame:
    """Term summary per year. A single word needs the year's dynamic threshold, which counts rows
    of any label; a phrase needs a total of five."""
    group = [year] if year else []
    rows = df.dropna(subset=group) if group else df
    labelled = rows.filter(F.col(label).isin(0, 1))
    terms = ngram_terms(labelled, [*group, label], text, sizes, stopwords)
    summary = summarize_terms(terms, group, label)
    sized = rows.groupBy(*group).agg(F.count("*").alias("_rows"))
    thresholds = sized.select(*group, ms.term_threshold(F.col("_rows"), F.lit(1)).alias("_min"))
    if group:
        summary = summary.join(small(thresholds), group)
    else:
        summary = summary.withColumn("_min", F.lit(thresholds.first()["_min"]))
    needed = F.when(F.col("ngram_size") == 1, F.col("_min")).otherwise(F.lit(PHRASE_MIN_TOTAL))
    return summary.filter(F.col("total_count") >= needed).drop("_min")


def thresholds_by_year(df: DataFrame, year: str = "year", sizes: Sequence[int] = (1, 2, 3)) -> DataFrame:
    rows = df.dropna(subset=[year]).groupBy(year).agg(F.count("*").alias("num_rows"))
    sized = rows.withColumn("ngram_size", F.explode(F.array(*[F.lit(n) for n in sizes])))
    return sized.withColumn("threshold", ms.term_threshold(F.col("num_rows"), F.col("ngram_size")))


def vocabulary_gate(summary: DataFrame, known: DataFrame, min_total: int = VOCAB_MIN_TOTAL) -> DataFrame:
    """Fixed minimum total; a phrase also needs a word of the given vocabulary (column ``term``)."""
    kept = summary.filter(F.col("total_count") >= min_total)
    phrases = kept.filter("ngram_size > 1")
    anchored = (phrases.select("term", F.explode(F.array_distinct(F.split("term", " "))).alias("_word")).distinct()
                .join(small(known.select(F.col("term").alias("_word")).distinct()), "_word", "left_semi")
                .select("term").distinct())
    return kept.filter("ngram_size = 1").unionByName(phrases.join(anchored, "term", "left_semi"))


def ascii_gate(terms: DataFrame, col: str = "term") -> DataFrame:
    """Terms of ASCII letters only. Phrases contain a space and therefore all go."""
    return terms.filter(F.col(col).rlike("^[A-Za-z]+$"))


def noise_gate(df: DataFrame, text: str, label: str, sizes: Sequence[int] = (1, 2, 3),
               stopwords: Sequence[str] = (), lemmas: Mapping[str, str] | None = None,
               min_total: int = NOISE_MIN_TOTAL, min_relevance: float = NOISE_MIN_RELEVANCE) -> DataFrame:
    """Variant: stopwords go and lemmas are mapped before tokenising, stopwords again before
    phrases are formed; keeps terms above the minimum total and relevance."""
    labelled = df.filter(F.col(label).isin(0, 1))
    stop = list(stopwords)
    kept_words = F.filter(tx.words(F.col(text)), lambda w: ~F.lower(w).isin(stop or [""]))
    base = labelled.select(label, tx.word_tokens(
        F.array_join(tx.lemmatize(kept_words, lemmas or {}), " ")).alias("_one"))
    base = base.withColumn("_many", tx.drop_words(F.col("_one"), stop))
    one, many = F.col("_one"), F.col("_many")
    terms = article_terms(base, [label], {n: one if n == 1 else many for n in sizes})
    counts = terms.groupBy("ngram_size", "term").agg(
        F.sum(F.when(F.col(label) == 1, F.col("cnt")).otherwise(0)).alias("count_real"),
        F.sum(F.when(F.col(label) == 0, F.col("cnt")).otherwise(0)).alias("count_dubious"))
    score = ms.relevance(F.col("count_real"), F.col("count_dubious"), places=None)
    return (counts.withColumns({
        "in_real": F.col("count_real") > 0, "in_dubious": F.col("count_dubious") > 0,
        "is_phrase": F.col("ngram_size") > 1,
        "total_count": F.col("count_real") + F.col("count_dubious"), "relevance_score": score})
        .filter((F.col("total_count") > min_total) & (F.col("relevance_score") > min_relevance)))


def histogram(df: DataFrame, value: Column, low: float, high: float, bins: int,
              keys: Sequence[str] = ()) -> DataFrame:
    """Counts per equal-width bin over [low, high]; the last bin includes its upper edge and values
    outside are left out."""
    width = (high - low) / bins
    v = value.cast("double")
    bin_no = F.least(F.floor((v - F.lit(float(low))) / F.lit(width)).cast("int"), F.lit(bins - 1))
    return (df.filter(v.between(float(low), float(high))).select(*keys, bin_no.alias("bin"))
            .groupBy(*keys, "bin").agg(F.count("*").alias("n")))


def count_histogram(summary: DataFrame, bins: int = 100, high: float = 1000) -> DataFrame:
    """Distribution of term totals, with the logarithm of the frequency."""
    total = F.col("count_real") + F.col("count_dubious")
    return histogram(summary, total, 0, high, bins).withColumn("log10_n", F.log10("n"))


def cloud_subsets(summary: DataFrame, group: Sequence[str] = ("year", "ngram_size")) -> DataFrame:
    """Weighted terms of the six word clouds: all, real, dubious, common, real_only, dubious_only.

    ``all`` holds both class counts, ``common`` only the real count."""
    real, dubious = F.col("count_real"), F.col("count_dubious")
    clouds = {
        "all": real + dubious,
        "real": F.when(F.col("in_real"), real),
        "dubious": F.when(F.col("in_dubious"), dubious),
        "common": F.when(F.col("in_real") & F.col("in_dubious"), real),
        "real_only": F.when(F.col("in_real") & ~F.col("in_dubious"), real),
        "dubious_only": F.when(F.col("in_dubious") & ~F.col("in_real"), dubious),
    }
    rows = F.array(*[F.struct(F.lit(n).alias("subset"), w.cast("bigint").alias("weight"))
                     for n, w in clouds.items()])
    return (summary.select(*group, "term", F.explode(rows).alias("c"))
            .select(*group, "c.subset", "term", "c.weight").filter("weight > 0"))


def repeat_terms(weights: DataFrame, term: str = "term", weight: str = "weight",
                 chunk: int = REPEAT_CHUNK) -> DataFrame:
    """The cloud as text: each term followed by a space, ``weight`` times, as rows of ``fragment``.

    A row per term, cut into several for very frequent terms, so that no string has to hold a
    whole cloud; written with ``sources.writers.save_text`` they are the concatenated text.
    """
    parts = F.ceil(F.col(weight) / F.lit(chunk)).cast("int")
    out = (weights.filter(F.col(weight) > 0)
           .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))))
    times = F.least(F.lit(chunk).cast("bigint"), F.col(weight) - F.col("part").cast("bigint") * F.lit(chunk))
    return out.withColumn("fragment", F.repeat(F.concat(F.col(term), F.lit(" ")), times.cast("int")))


def word_counts(df: DataFrame, text: str, stopwords: Sequence[str] = ()) -> DataFrame:
    """Word frequencies without stopwords."""
    tokens = tx.drop_words(tx.word_tokens(F.col(text)), stopwords)
    return df.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count("*").alias("cnt"))


def phrase_counts_by_class(df: DataFrame, text: str, label: str, n: int = 2,
                           stopwords: Sequence[str] = ()) -> DataFrame:
    """Phrases of non-stopwords counted per class."""
    tokens = df.dropna(subset=[label]).select(
        F.col(label).alias("label"), tx.drop_words(tx.word_tokens(F.col(text)), stopwords).alias("_tokens"))
    return (tokens.select("label", F.explode(ls.phrases(F.col("_tokens"), n)).alias("term"))
            .groupBy("label", "term").agg(F.count("*").alias("cnt")))


def class_totals(df: DataFrame, dim: str, label: str = "label") -> DataFrame:
    """Real and dubious articles per dimension value."""
    return (df.dropna(subset=[dim]).groupBy(dim)
            .agg(count_if(F.col(label) == 0).alias("dubious"), count_if(F.col(label) == 1).alias("real")))
