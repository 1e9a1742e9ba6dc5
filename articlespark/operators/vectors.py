"""Sparse Spark ML vectors made by grouping rows, and text vectors over a vocabulary kept as a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lists as ls
from ..functions import text as tx
from ..runtime import materialize, shared_path, small
from .ordering import dense_ids

#: Spark ML counts coordinates in 32 bits.
MAX_SIZE = (1 << 31) - 1


def sparse(entries: Column, size: int) -> Column:
    """The parts of a sparse vector from an array of structs (index, value) in the order of index; zeros are left out. Null
    gives the zero vector."""
    if size > MAX_SIZE:
        raise ValueError(f"{size} coordinates are more than a vector can have")
    kept = F.coalesce(F.filter(entries, lambda e: e["value"] != 0), F.array())
    return F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"),
                    F.transform(kept, lambda e: e["index"].cast("int")).alias("indices"),
                    F.transform(kept, lambda e: e["value"]).alias("values"))


def as_vectors(df: DataFrame, column: str, label: str = "vectors") -> DataFrame:
    """Write ``df`` with the parts of a vector and read them back as the vector type, whose stored form is those parts."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name == column else f.dataType) for f in df.schema]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def with_parts(df: DataFrame, column: str, label: str = "parts") -> DataFrame:
    """The reverse: write ``df`` and read its vectors as structs (type, size, indices, values); type 0 is sparse, and a dense
    vector has values only."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT.sqlType() if f.name == column else f.dataType) for f in df.schema]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def coordinates(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """(keys, index, value): a row per stored coordinate of a sparse vector."""
    parts = with_parts(df.select(*keys, column), column)
    return parts.select(*keys, F.explode(F.arrays_zip(f"{column}.indices", f"{column}.values")).alias("_e")).select(
        *keys, F.col("_e.indices").cast("long").alias("index"), F.col("_e.values").alias("value"))


@dataclass
class TermModel:
    """A fitted text vectoriser: term counts times smoothed idf, scaled to unit length.

    ``vocabulary`` is a table (term, index, docs, idf) of any length; only its length is known to the driver."""

    vocabulary: DataFrame
    size: int
    text_cols: Sequence[str]
    stopwords: Sequence[str] = ()

    def entries(self, df: DataFrame, key: str) -> DataFrame:
        """(key, entries): the article's terms with index and weight, in the order of index; articles without
        a known term are left out. Counting happens in the row; a frequent term meets the vocabulary in as many tasks as hold its articles."""
        counts = term_counts(df, key, self.text_cols, self.stopwords)
        known = counts.join(small(self.vocabulary.select("term", "index", "idf")), "term")
        entry = F.struct("index", "term", (F.col("cnt") * F.col("idf")).alias("value"))
        rows = known.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        norm = F.sqrt(F.aggregate("entries", F.lit(0.0), lambda s, e: s + e["value"] * e["value"]))
        unit = ls.let(norm, lambda n: F.transform("entries", lambda e: F.struct(
            e["index"].alias("index"), e["term"].alias("term"), (e["value"] / n).alias("value"))))
        return rows.select(key, unit.alias("entries"))

    def weights(self, df: DataFrame, key: str) -> DataFrame:
        """(key, term, weight): a row per article and term."""
        return self.entries(df, key).select(key, F.explode("entries").alias("e")).select(
            key, F.col("e.term").alias("term"), F.col("e.value").alias("weight"))

    def transform(self, df: DataFrame, key: str, keep: Sequence[str] = (), out: str = "features") -> DataFrame:
        """(key, ``keep``, ``out``): a sparse vector per article, the zero vector where no term is known. Keys are unique; a
        null key keeps the zero vector."""
        rows = df.select(key, *keep).join(self.entries(df, key), key, "left")
        return as_vectors(rows.select(key, *keep, sparse(F.col("entries"), self.size).alias(out)), out)

    def save(self, path: str) -> None:
        self.vocabulary.write.parquet(f"{path}/vocabulary")
        settings = (self.size, list(self.text_cols), list(self.stopwords))
        self.vocabulary.sparkSession.createDataFrame([settings], "size long, text_cols array<string>, stopwords array<string>").write.json(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TermModel:
        settings = spark.read.schema("size long, text_cols array<string>, stopwords array<string>").json(f"{path}/settings").first()
        return cls(spark.read.parquet(f"{path}/vocabulary"), settings["size"], settings["text_cols"], settings["stopwords"])


def term_counts(df: DataFrame, key: str, text_cols: Sequence[str], stopwords: Sequence[str] = ()) -> DataFrame:
    """(key, term, cnt): words of two or more characters of the joined columns, lower case without punctuation."""
    joined = tx.lower_no_punct(*[F.col(c) for c in text_cols])
    tokens = df.select(key, tx.drop_words(tx.word_tokens(joined), stopwords).alias("_tokens"))
    return tokens.select(key, F.explode(ls.run_lengths(F.col("_tokens"))).alias("r")).select(
        key, F.col("r.item").alias("term"), F.col("r.cnt").alias("cnt"))


def fit_terms(df: DataFrame, key: str, text_cols: Sequence[str], stopwords: Sequence[str] = (), min_docs: int = 1) -> TermModel:
    """Vocabulary and idf of ``df``: every term in at least ``min_docs`` articles, numbered in its order. The idf is
    ln((1 + articles) / (1 + articles with the term)) + 1."""
    docs = (term_counts(df, key, text_cols, stopwords).groupBy("term").agg(F.count("*").alias("docs"))
            .where(F.col("docs") >= min_docs))
    idf = F.log(F.lit(1.0 + df.count()) / (F.col("docs") + 1.0)) + 1.0
    vocabulary = materialize(dense_ids(docs, ["term"], "index").withColumn("idf", idf), "vocabulary")
    return TermModel(vocabulary, vocabulary.count(), list(text_cols), list(stopwords))
