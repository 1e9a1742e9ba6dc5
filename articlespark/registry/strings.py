"""String functions."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import textjobs
from ..operators.transformers import TextCleaning, TextPreprocessor
from ..runtime import shared_path
from .core import (ARTICLES, DATELINED, LEMMAS, MEASURED, SP, STOP_SQL, STOPWORDS, WD, articles, datelined, lemma_sql,
                   literal, measured, no_punct_sql, register, strip_sql, table, words_sql)


@register("punct_strip", f"SELECT doc_id, md5({no_punct_sql('text')}) AS clean_md5 FROM documents")
def punct_strip(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(tx.strip_punct(F.col("text"))).alias("clean_md5"))


_SOURCE = rf"{strip_sql(rf'''regexp_extract(article_text, '^[A-Za-z{SP},/.]+ \([A-Za-z]+\) -', 0)''')}"


@register("dateline_extract", rf"""WITH {DATELINED}, s AS (SELECT article_id, article_text, {_SOURCE} AS source FROM datelined)
SELECT article_id, source, md5(CASE WHEN source <> '' THEN {strip_sql("replace(article_text, source, '')")}
                               ELSE article_text END) AS text_md5 FROM s""")
def dateline_extract(spark, d):
    source, rest = tx.dateline(F.col("article_text"))
    return datelined(spark, d).select("article_id", source.alias("source"), F.md5(rest).alias("text_md5"))


@register("source_split", rf"""WITH {DATELINED}, s AS (SELECT article_id,
  CASE WHEN {_SOURCE} = '' THEN 'UNKNOWN (Unknown)' ELSE {_SOURCE} END AS source FROM datelined)
SELECT article_id, {strip_sql(r"regexp_replace(source, '\([^\n]*?\)| -', '', 'g')")} AS location,
       regexp_extract(source, '\(([^\n]*?)\)', 1) AS source_name FROM s""")
def source_split(spark, d):
    source, _ = tx.dateline(F.col("article_text"))
    s = datelined(spark, d).select("article_id", F.when(source == "", "UNKNOWN (Unknown)").otherwise(source).alias("s"))
    location, name = tx.source_parts(F.col("s"))
    return s.select("article_id", location.alias("location"), name.alias("source_name"))


@register("source_split_strict", rf"""WITH {DATELINED}, s AS (SELECT article_id, {_SOURCE} AS source FROM datelined)
SELECT article_id, '' AS location, '' AS source_name FROM s""")
def source_split_strict(spark, d):
    source, _ = tx.dateline(F.col("article_text"))
    s = datelined(spark, d).select("article_id", source.alias("s"))
    location, name = tx.source_parts_strict(F.col("s"))
    return s.select("article_id", location.alias("location"), name.alias("source_name"))


def clean_sql(text: str, lemmas: bool = False) -> str:
    tagless = rf"regexp_replace({text}, '<[^\n]*?>', '', 'g')"
    kept = f"list_filter({words_sql(f'lower({no_punct_sql(tagless)})')}, lambda w: w NOT IN {STOP_SQL})"
    if lemmas:
        kept = f"list_transform({kept}, lambda w: {lemma_sql('w')})"
    return f"array_to_string({kept}, ' ')"


@register("text_clean", f"""SELECT 'page' AS kind, page_id AS id, md5({clean_sql('html')}) AS clean_md5 FROM pages
UNION ALL SELECT 'document', doc_id, md5({clean_sql('text')}) FROM documents""")
def text_clean(spark, d):
    def part(kind, name, key, col):
        cleaned = tx.clean_text(F.col(col), STOPWORDS)
        return table(spark, d, name).select(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.md5(cleaned).alias("clean_md5"))

    return part("page", "pages", "page_id", "html").unionByName(part("document", "documents", "doc_id", "text"))


@register("text_lemma", f"SELECT doc_id, md5({clean_sql('text', True)}) AS clean_md5 FROM documents")
def text_lemma(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(tx.clean_text(F.col("text"), STOPWORDS, LEMMAS)).alias("clean_md5"))


@register("text_lemma_table", f"SELECT doc_id, md5({clean_sql('text', True)}) AS clean_md5 FROM documents")
def text_lemma_table(spark, d):
    tokens = table(spark, d, "documents").select("doc_id", tx.clean_tokens(F.col("text"), STOPWORDS).alias("tokens"))
    lemmas = literal(spark, list(LEMMAS.items()), "form string, lemma string")
    return textjobs.lemmatize_join(tokens, "doc_id", "tokens", lemmas).select(
        "doc_id", F.md5(F.array_join("tokens", " ")).alias("clean_md5"))


def _cloud_sql(text: str) -> str:
    return (f"array_to_string(list_filter({words_sql(rf'''regexp_replace(lower({text}), '[^a-z{SP}]', '', 'g')''')}, "
            f"lambda w: w NOT IN {STOP_SQL} AND length(w) > 2), ' ')")


@register("wc_clean", f"""WITH {ARTICLES}
SELECT article_id, md5({_cloud_sql("coalesce(title, '') || ' ' || article_text")}) AS cloud_md5,
       md5(array_to_string({words_sql('lower(article_text)')}, ' ')) AS kept_md5 FROM articles""")
def wc_clean(spark, d):
    both = tx.title_and_text(F.col("title"), F.col("article_text"))
    return articles(spark, d).select(
        "article_id", F.md5(tx.cloud_clean(both, STOPWORDS)).alias("cloud_md5"),
        F.md5(tx.cloud_clean(F.col("article_text"), remove_stopwords=False, remove_punctuation=False)).alias("kept_md5"))


@register("svc_clean", f"""WITH {ARTICLES}
SELECT article_id, md5({no_punct_sql('lower(article_text)')}) AS one_md5,
       md5({no_punct_sql('lower(title)')} || ' ' || {no_punct_sql('lower(article_text)')}) AS two_md5 FROM articles""")
def svc_clean(spark, d):
    title, text = F.col("title"), F.col("article_text")
    return articles(spark, d).select("article_id", F.md5(tx.lower_no_punct(text)).alias("one_md5"),
                                     F.md5(tx.lower_no_punct(title, text)).alias("two_md5"))


@register("svc_pipeline", f"""WITH {ARTICLES}
SELECT article_id, md5({no_punct_sql("lower(coalesce(article_text, ''))")}) AS one_md5,
       md5({no_punct_sql("lower(coalesce(title, ''))")} || ' ' || {no_punct_sql("lower(coalesce(article_text, ''))")}) AS two_md5 FROM articles""")
def svc_pipeline(spark, d):
    """Both cleaning stages in a pipeline that was saved and loaded."""
    path = shared_path(spark, "cleaning")
    PipelineModel([TextCleaning(inputCol="article_text", outputCol="one"),
                   TextPreprocessor(inputCols=["title", "article_text"], outputCol="two")]).save(path)
    return PipelineModel.load(path).transform(articles(spark, d)).select("article_id", F.md5("one").alias("one_md5"), F.md5("two").alias("two_md5"))


_CONTRACTIONS = (rf"list_filter(regexp_extract_all(lower(replace(replace(text, '‘', ''''), '’', '''')), "
                 rf"'[{WD}]+(?:''[{WD}]+)*'), lambda w: regexp_full_match(w, '[a-z]+(''[a-z]+)?') AND w NOT IN {STOP_SQL})")


@register("smart_quotes", f"SELECT doc_id, CAST(len({_CONTRACTIONS}) AS INT) AS n, "
                          f"md5(array_to_string({_CONTRACTIONS}, ' ')) AS tokens_md5 FROM "
                          "(SELECT doc_id, replace(text, ' the ', ' the’s ') AS text FROM documents)")
def smart_quotes(spark, d):
    quoted = table(spark, d, "documents").select("doc_id", F.replace(F.col("text"), F.lit(" the "), F.lit(" the’s ")).alias("text"))
    t = quoted.select("doc_id", tx.contraction_tokens(F.col("text"), STOPWORDS).alias("t"))
    return t.select("doc_id", F.size("t").alias("n"), F.md5(F.array_join("t", " ")).alias("tokens_md5"))


@register("alpha_lemma_clean", rf"""SELECT doc_id, md5(array_to_string(list_transform(list_filter(
  regexp_extract_all(text, '[{WD}]+'), lambda w: regexp_full_match(w, '\p{{L}}+') AND lower(w) NOT IN {STOP_SQL}),
  lambda w: {lemma_sql('lower(w)')}), ' ')) AS tokens_md5 FROM documents""")
def alpha_lemma_clean(spark, d):
    tokens = tx.alpha_lemma_tokens(F.col("text"), STOPWORDS, LEMMAS)
    return table(spark, d, "documents").select("doc_id", F.md5(F.array_join(tokens, " ")).alias("tokens_md5"))


def _media_sql(text: str) -> str:
    rules = " ".join(f"WHEN regexp_matches(lower({text}), '{'|'.join(keys)}') THEN '{name}'"
                     for name, keys in tx.MEDIA_KEYWORDS.items())
    return f"CASE {rules} ELSE 'text' END"


@register("media_classify", f"""SELECT 'conversation' AS kind, conv_id * 1000 + turn AS id, {_media_sql('text')} AS media_type
FROM conversations UNION ALL SELECT 'document', doc_id, {_media_sql('text')} FROM documents""")
def media_classify(spark, d):
    media = tx.media_type(F.col("text")).alias("media_type")
    return (table(spark, d, "conversations").select(F.lit("conversation").alias("kind"),
                                                    (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), media)
            .unionByName(table(spark, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), media)))


MEDIA_COMBINED_SQL = f"CASE WHEN ({_media_sql('title')}) <> 'text' THEN ({_media_sql('title')}) ELSE ({_media_sql('article_text')}) END"


@register("media_combine", f"WITH {ARTICLES} SELECT article_id, {MEDIA_COMBINED_SQL} AS media_type FROM articles")
def media_combine(spark, d):
    combined = tx.combined_media_type(tx.media_type(F.col("title")), tx.media_type(F.col("article_text")))
    return articles(spark, d).select("article_id", combined.alias("media_type"))


@register("text_lengths", f"""WITH {ARTICLES}
SELECT article_id, CAST(length(title) AS INT) AS title_length, CAST(length(article_text) AS INT) AS text_length FROM articles""")
def text_lengths(spark, d):
    return articles(spark, d).select("article_id", F.length("title").alias("title_length"),
                                     F.length("article_text").alias("text_length"))


def _polarity_sql(c):
    return f"CASE WHEN {c} > 0 THEN 'positive' WHEN {c} < 0 THEN 'negative' ELSE 'neutral' END"


def _subjectivity_sql(c):
    return (f"CASE WHEN {c} > 0.8::DOUBLE THEN 'highly subjective' WHEN {c} > 0.6::DOUBLE THEN 'subjective' "
            f"WHEN {c} > 0.4::DOUBLE THEN 'neutral' WHEN {c} > 0.2::DOUBLE THEN 'objective' ELSE 'higly objective' END")


@register("polarity_band", f"WITH {MEASURED} SELECT l_orderkey, l_linenumber, {_polarity_sql('article_polarity')} AS band FROM measured")
def polarity_band(spark, d):
    return measured(spark, d).select("l_orderkey", "l_linenumber", tx.polarity_band(F.col("article_polarity")).alias("band"))


@register("subjectivity_band", f"WITH {MEASURED} SELECT l_orderkey, l_linenumber, {_subjectivity_sql('article_subjectivity')} AS band FROM measured")
def subjectivity_band(spark, d):
    return measured(spark, d).select("l_orderkey", "l_linenumber", tx.subjectivity_band(F.col("article_subjectivity")).alias("band"))


@register("sentiment_label", f"""WITH {MEASURED} SELECT l_orderkey, l_linenumber,
({_polarity_sql('title_polarity')}) || ' ' || ({_subjectivity_sql('title_subjectivity')}) AS sentiment_title FROM measured""")
def sentiment_label(spark, d):
    return measured(spark, d).select("l_orderkey", "l_linenumber", tx.sentiment_label(
        F.col("title_polarity"), F.col("title_subjectivity")).alias("sentiment_title"))


_ADDRESSES = """addresses AS (SELECT c_custkey, CASE c_custkey % 10
  WHEN 0 THEN c_name || ', NY ' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') || ', USA'
  WHEN 1 THEN c_name || ', new south wales 2000, Australia'
  WHEN 2 THEN c_name || ', ' || c_mktsegment || ', UK'
  WHEN 3 THEN c_name || ', Var ' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') || ', France'
  WHEN 4 THEN c_name || ', Ontario, Canada' WHEN 5 THEN c_name || ', Otago, New Zealand'
  WHEN 6 THEN c_name || ', Goa, India' WHEN 7 THEN c_name || ', Salta, Argentina' WHEN 8 THEN c_name END AS address FROM customer)"""


def _addresses(spark, d):
    k, name = F.col("c_custkey"), F.col("c_name")
    digits = F.lpad(k.cast("string"), 5, "0")
    tails = [F.concat(F.lit(", NY "), digits, F.lit(", USA")), F.lit(", new south wales 2000, Australia"),
             F.concat(F.lit(", "), "c_mktsegment", F.lit(", UK")), F.concat(F.lit(", Var "), digits, F.lit(", France")),
             F.lit(", Ontario, Canada"), F.lit(", Otago, New Zealand"), F.lit(", Goa, India"), F.lit(", Salta, Argentina"),
             F.lit(""), F.lit(None)]
    tail = F.coalesce(*[F.when(k % 10 == i, t) for i, t in enumerate(tails)])
    return table(spark, d, "customer").select("c_custkey", F.concat(name, tail).alias("address"))


@register("address_parts", f"""WITH {_ADDRESSES}, p AS (SELECT c_custkey, string_split(address, ', ') AS p FROM addresses)
SELECT c_custkey, p[-3] AS continent, p[-1] AS country, p[-2] AS state FROM p""")
def address_parts(spark, d):
    continent, country, state = tx.address_parts(F.col("address"))
    return _addresses(spark, d).select("c_custkey", continent.alias("continent"), country.alias("country"), state.alias("state"))


def _state_sql():
    parts = ", ".join(f"nullif(regexp_extract(address, '{p}', 1), '')" for p in tx.STATE_PATTERNS)
    return f"coalesce({parts})"


@register("address_state", f"""WITH {_ADDRESSES}, s AS (SELECT c_custkey, address, {strip_sql(_state_sql())} AS s FROM addresses)
SELECT c_custkey, array_to_string(list_transform(string_split(lower(s), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS state,
       trim(string_split(address, ',')[-1]) AS country FROM s""")
def address_state(spark, d):
    a = F.col("address")
    return _addresses(spark, d).select("c_custkey", tx.address_state(a).alias("state"), tx.address_country(a).alias("country"))


@register("join_list_text", """SELECT doc_id, md5(text || ' ' || array_to_string([lang, source], ' ')) AS text_md5 FROM documents""")
def join_list_text(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.md5(tx.join_list(F.col("text"), F.array("lang", "source"))).alias("text_md5"))
