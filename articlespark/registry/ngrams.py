"""N-gram summaries, themes, clouds and lexicon sentiment."""

from pyspark.sql import functions as F

from ..operators import ngrams as ng
from ..operators import textjobs
from ..runtime import materialize
from .core import (ARTICLES, LEMMAS, NLP, NOUNS, NOUNS_SQL, SENTIMENT, SENTIMENT_SQL, STOP_SQL, STOPWORDS, WD, articles,
                   lemma_sql, literal, nlp_sql, nlp_text, register, tokens_sql, words_sql)

_CLEAN = (rf"regexp_extract_all(array_to_string(list_filter(regexp_extract_all(lower(replace(replace(text, '‘', ''''), '’', '''')), "
          rf"'[{WD}]+(?:''[{WD}]+)*'), lambda w: regexp_full_match(w, '[a-z]+(''[a-z]+)?') AND w NOT IN {STOP_SQL}), ' '), '[{WD}]{{2,}}')")
_DOCS = """docs AS (SELECT article_id, article_text AS text, label, CAST(year(date_clean) AS INT) AS year FROM articles)"""
# Token positions, then neighbouring tokens by lead; one row per occurrence of a term
OCCURRENCES = f"""{ARTICLES}, {_DOCS},
one AS (SELECT article_id, label, year, unnest({_CLEAN}) AS term FROM docs WHERE label IN (0, 1)),
raw AS (SELECT article_id, label, year, unnest({tokens_sql('text')}) AS w, generate_subscripts({tokens_sql('text')}, 1) AS i FROM docs WHERE label IN (0, 1)),
nxt AS (SELECT article_id, label, year, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM raw WINDOW p AS (PARTITION BY article_id ORDER BY i)),
occurrences AS (SELECT article_id, label, year, 1 AS ngram_size, term FROM one
  UNION ALL SELECT article_id, label, year, 2, w || ' ' || w2 FROM nxt WHERE w2 IS NOT NULL AND NOT (w IN {STOP_SQL} AND w2 IN {STOP_SQL})
  UNION ALL SELECT article_id, label, year, 3, w || ' ' || w2 || ' ' || w3 FROM nxt
            WHERE w3 IS NOT NULL AND NOT (w IN {STOP_SQL} AND w2 IN {STOP_SQL} AND w3 IN {STOP_SQL}))"""


def _stats(label, name):
    c = f"CASE WHEN label = {label} THEN cnt END"
    return (f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS count_{name}, CAST(coalesce(max({c}), 0) AS BIGINT) AS max_{name}, "
            f"round_even(coalesce(avg({c}), 0) * 10000::DOUBLE, 0) / 10000 AS mean_{name}, "
            f"round_even(coalesce(stddev_pop({c}), 0) * 10000::DOUBLE, 0) / 10000 AS stdev_{name}")


def summary_sql(group: str) -> str:
    g = f"{group}, " if group else ""
    rows = f"SELECT {g}greatest(CAST(floor(count(*) * 0.005::DOUBLE) AS BIGINT), 10) AS low FROM docs {'GROUP BY ' + group if group else ''}"
    return f"""{OCCURRENCES},
per_article AS (SELECT {g}article_id, label, ngram_size, term, count(*) AS cnt FROM occurrences GROUP BY ALL),
sums AS (SELECT {g}ngram_size, term, {_stats(1, 'real')}, {_stats(0, 'dubious')} FROM per_article GROUP BY {g}ngram_size, term),
low AS ({rows}),
summary AS (SELECT s.*, ngram_size > 1 AS is_phrase, count_real + count_dubious AS total_count, count_real > 0 AS in_real, count_dubious > 0 AS in_dubious,
  round_even(abs(count_real - count_dubious) / (count_real + count_dubious) * 10000::DOUBLE, 0) / 10000 AS relevance_score
  FROM sums s {'JOIN low USING (' + group + ')' if group else 'CROSS JOIN low'}
  WHERE count_real + count_dubious >= CASE WHEN ngram_size = 1 THEN low ELSE 5 END)"""


_COLS = ("ngram_size, term, is_phrase, count_real, count_dubious, total_count, in_real, in_dubious, max_real, mean_real, stdev_real, "
         "max_dubious, mean_dubious, stdev_dubious, relevance_score")


def docs(spark, d):
    return articles(spark, d).select("article_id", F.col("article_text").alias("text"), "label", F.year("date_clean").alias("year"))


def summary(spark, d, year="year"):
    return ng.ngram_summary(docs(spark, d), "text", "label", year, (1, 2, 3), STOPWORDS)


@register("ngram_summary", f"WITH {summary_sql('')} SELECT {_COLS} FROM summary")
def ngram_summary(spark, d):
    return summary(spark, d, None).select(*_COLS.split(", "))


@register("ngram_by_year", f"WITH {summary_sql('year')} SELECT year, {_COLS} FROM summary")
def ngram_by_year(spark, d):
    return summary(spark, d).select("year", *_COLS.split(", "))


# All terms, one row per first hexadecimal digits of their hash: how many, how often, and a sum over (term, count) pairs
@register("ngram_terms", f"""WITH {OCCURRENCES}, t AS (SELECT label, ngram_size, term, count(*) AS cnt FROM occurrences GROUP BY ALL)
SELECT label, ngram_size, substr(md5(term), 1, 2) AS part, CAST(count(*) AS BIGINT) AS terms, CAST(sum(cnt) AS BIGINT) AS occurrences,
       CAST(sum(CAST('0x' || substr(md5(term || ' ' || CAST(cnt AS VARCHAR)), 1, 8) AS BIGINT)) AS BIGINT) AS digest
FROM t GROUP BY ALL""")
def ngram_terms(spark, d):
    labelled = docs(spark, d).filter(F.col("label").isin(0, 1))
    terms = ng.ngram_terms(labelled, ["label"], "text", (1, 2, 3), STOPWORDS)
    counts = terms.groupBy("label", "ngram_size", "term").agg(F.sum("cnt").alias("cnt"))
    pair = F.conv(F.substring(F.md5(F.concat_ws(" ", "term", F.col("cnt").cast("string"))), 1, 8), 16, 10).cast("bigint")
    return counts.groupBy("label", "ngram_size", F.substring(F.md5("term"), 1, 2).alias("part")).agg(
        F.count("*").alias("terms"), F.sum("cnt").alias("occurrences"), F.sum(pair).alias("digest"))


@register("ngram_stop_filter", f"""WITH {OCCURRENCES} SELECT ngram_size, CAST(count(*) AS BIGINT) AS occurrences, CAST(count(DISTINCT term) AS BIGINT) AS terms
FROM occurrences WHERE ngram_size > 1 GROUP BY ngram_size""")
def ngram_stop_filter(spark, d):
    terms = ng.ngram_terms(docs(spark, d).filter(F.col("label").isin(0, 1)), [], "text", (2, 3), STOPWORDS)
    per_term = terms.groupBy("ngram_size", "term").agg(F.sum("cnt").alias("cnt"))
    return per_term.groupBy("ngram_size").agg(F.sum("cnt").alias("occurrences"), F.count("*").alias("terms"))


@register("ngram_histogram", f"""WITH {summary_sql('')} SELECT CAST(least(floor(total_count / 10), 99) AS INT) AS bin, CAST(count(*) AS BIGINT) AS n,
round(log10(count(*)), 6) AS log10_n FROM summary WHERE total_count BETWEEN 0 AND 1000 GROUP BY 1""")
def ngram_histogram(spark, d):
    return ng.count_histogram(summary(spark, d, None)).withColumn("log10_n", F.round("log10_n", 6))


CLOUDS = f"""{summary_sql('year')}, clouds AS (
  SELECT year, ngram_size, 'all' AS subset, term, count_real + count_dubious AS weight FROM summary
  UNION ALL SELECT year, ngram_size, 'real', term, count_real FROM summary WHERE in_real
  UNION ALL SELECT year, ngram_size, 'dubious', term, count_dubious FROM summary WHERE in_dubious
  UNION ALL SELECT year, ngram_size, 'common', term, count_real FROM summary WHERE in_real AND in_dubious
  UNION ALL SELECT year, ngram_size, 'real_only', term, count_real FROM summary WHERE in_real AND NOT in_dubious
  UNION ALL SELECT year, ngram_size, 'dubious_only', term, count_dubious FROM summary WHERE in_dubious AND NOT in_real)"""


@register("ngram_cloud_subsets", f"WITH {CLOUDS} SELECT * FROM clouds WHERE weight > 0")
def ngram_cloud_subsets(spark, d):
    return ng.cloud_subsets(summary(spark, d))


@register("repeat_terms", f"""WITH {CLOUDS} SELECT year, ngram_size, subset, term, CAST(weight * (length(term) + 1) AS BIGINT) AS characters,
md5(CASE WHEN weight >= 65536 THEN repeat(md5(repeat(term || ' ', 65536)), weight // 65536) ELSE '' END
    || CASE WHEN weight % 65536 > 0 THEN md5(repeat(term || ' ', weight % 65536)) ELSE '' END) AS text_md5 FROM clouds WHERE weight > 0""")
def repeat_terms(spark, d):
    fragments = ng.repeat_terms(ng.cloud_subsets(summary(spark, d)))
    # the hash of the hashes of a term's fragments in order; a term has one per 65,536 occurrences
    parts = F.sort_array(F.collect_list(F.struct("part", F.md5("fragment").alias("h"))))
    return fragments.groupBy("year", "ngram_size", "subset", "term").agg(
        F.sum(F.length("fragment")).alias("characters"), F.md5(F.array_join(parts["h"], "")).alias("text_md5"))


@register("ngram_vocab_gate", f"""WITH {summary_sql('')}, kept AS (SELECT * FROM summary WHERE total_count >= 20),
known AS (SELECT term FROM summary WHERE ngram_size = 1 AND total_count >= 50)
SELECT ngram_size, term, total_count FROM kept k WHERE ngram_size = 1 OR EXISTS (SELECT 1 FROM known WHERE list_contains(string_split(k.term, ' '), known.term))""")
def ngram_vocab_gate(spark, d):
    s = materialize(summary(spark, d, None), "summary")
    known = s.filter("ngram_size = 1 AND total_count >= 50")
    return ng.vocabulary_gate(s, known, min_total=20).select("ngram_size", "term", "total_count")


@register("ngram_ascii_gate", f"""WITH {summary_sql('')} SELECT ngram_size, term FROM summary WHERE regexp_full_match(term, '[A-Za-z]+')""")
def ngram_ascii_gate(spark, d):
    return ng.ascii_gate(summary(spark, d, None)).select("ngram_size", "term")


_NOISE_TOKENS = f"""docs2 AS (SELECT article_id, label, {tokens_sql(
    f"array_to_string(list_transform(list_filter({words_sql('article_text')}, lambda w: lower(w) NOT IN {STOP_SQL}), lambda w: {lemma_sql('w')}), ' ')")} AS t
  FROM articles WHERE label IN (0, 1)),
one AS (SELECT label, 1 AS n, unnest(t) AS term FROM docs2),
many AS (SELECT article_id, label, list_filter(t, lambda w: w NOT IN {STOP_SQL}) AS t FROM docs2),
pos AS (SELECT article_id, label, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM many),
nxt AS (SELECT label, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM pos WINDOW p AS (PARTITION BY article_id ORDER BY i)),
occ AS (SELECT * FROM one UNION ALL SELECT label, 2, w || ' ' || w2 FROM nxt WHERE w2 IS NOT NULL
        UNION ALL SELECT label, 3, w || ' ' || w2 || ' ' || w3 FROM nxt WHERE w3 IS NOT NULL),
c AS (SELECT n AS ngram_size, term, CAST(count_if(label = 1) AS BIGINT) AS r, CAST(count_if(label = 0) AS BIGINT) AS f FROM occ GROUP BY ALL)"""


@register("ngram_noise_gate", f"""WITH {ARTICLES}, {_NOISE_TOKENS}
SELECT ngram_size, term, r AS count_real, f AS count_dubious, r + f AS total_count, round(abs(r - f) / (r + f), 6) AS relevance_score
FROM c WHERE r + f > 10 AND abs(r - f) / (r + f) > 0.5""")
def ngram_noise_gate(spark, d):
    out = ng.noise_gate(docs(spark, d), "text", "label", (1, 2, 3), STOPWORDS, LEMMAS)
    return out.select("ngram_size", "term", "count_real", "count_dubious", "total_count",
                      F.round("relevance_score", 6).alias("relevance_score"))


@register("themes_by_year", f"""WITH {ARTICLES}, {NOUNS_SQL}, w AS (SELECT CAST(year(date_clean) AS INT) AS year, unnest({tokens_sql('article_text')}) AS form FROM articles)
SELECT year, lemma AS theme, CAST(count(*) AS BIGINT) AS count FROM w JOIN nouns USING (form) GROUP BY ALL""")
def themes_by_year(spark, d):
    return textjobs.themes(docs(spark, d), "text", literal(spark, NOUNS, "form string, lemma string"))


@register("agg_sentiment", f"""WITH {ARTICLES}, {NLP}, {SENTIMENT_SQL},
t AS (SELECT article_id, nlp_text, {nlp_sql("title")} AS nlp_title FROM nlp JOIN articles USING (article_id)),
a AS (SELECT article_id, avg(polarity) AS p, avg(subjectivity) AS s FROM (SELECT article_id, unnest(string_split(nlp_text, ' ')) AS word FROM t) JOIN sentiment USING (word) GROUP BY 1),
h AS (SELECT article_id, avg(polarity) AS p, avg(subjectivity) AS s FROM (SELECT article_id, unnest(string_split(nlp_title, ' ')) AS word FROM t) JOIN sentiment USING (word) GROUP BY 1)
SELECT article_id, round(coalesce(a.p, 0), 6) AS article_polarity, round(coalesce(a.s, 0), 6) AS article_subjectivity,
       CASE WHEN article_id % 7 <> 0 THEN round(coalesce(h.p, 0), 6) END AS title_polarity,
       CASE WHEN article_id % 7 <> 0 THEN round(coalesce(h.s, 0), 6) END AS title_subjectivity
FROM t LEFT JOIN a USING (article_id) LEFT JOIN h USING (article_id)""")
def agg_sentiment(spark, d):
    texts = articles(spark, d).select("article_id", nlp_text(F.col("article_text")).alias("nlp_text"),
                                      F.when(F.col("article_id") % 7 != 0, nlp_text(F.col("title"))).alias("nlp_title"))
    lexicon = literal(spark, SENTIMENT, "word string, polarity double, subjectivity double")
    out = textjobs.lexicon_scores(texts, "article_id", {"article": F.col("nlp_text"), "title": F.col("nlp_title")}, lexicon)
    return out.select("article_id", *[F.round(f"{p}_{m}", 6).alias(f"{p}_{m}")
                                      for p in ("article", "title") for m in ("polarity", "subjectivity")])
