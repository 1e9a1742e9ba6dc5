"""List functions."""

from pyspark.sql import functions as F

from ..functions import lists as ls
from ..functions import text as tx
from ..operators import locations
from .core import STOPWORDS, register, table, words_sql
from .strings import clean_sql

_WORDS = words_sql("text")


@register("list_parse", f"""WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents)
SELECT doc_id, CAST(CASE WHEN doc_id % 3 = 0 THEN 0 ELSE len(w) END AS INT) AS n,
       md5(CASE WHEN doc_id % 3 = 0 THEN '' ELSE array_to_string(w, '|') END) AS items_md5 FROM w""")
def list_parse(spark, d):
    """All words of a text as a written list, quotes and backslashes escaped; every third list is broken."""
    def quoted(w):
        return F.concat(F.lit("'"), F.regexp_replace(w, r"([\\'])", r"\\$1"), F.lit("'"))
    written = F.concat(F.lit("["), F.array_join(F.transform(tx.words(F.col("text")), quoted), ", "),
                       F.when(F.col("doc_id") % 3 == 0, F.lit(", broken")).otherwise(F.lit("]")))
    docs = table(spark, d, "documents").select("doc_id", ls.parse_list(written).alias("items"))
    return docs.select("doc_id", F.size("items").alias("n"), F.md5(F.array_join("items", "|")).alias("items_md5"))


@register("location_split", """SELECT doc_id, array_to_string([trim(lang), trim(source)], '|') AS places FROM documents WHERE doc_id % 3 <> 0
UNION ALL SELECT doc_id, 'UNKNOWN' FROM documents WHERE doc_id % 3 = 0""")
def location_split(spark, d):
    raw = F.when(F.col("doc_id") % 3 != 0, F.concat("lang", F.lit(" / "), "source"))
    return table(spark, d, "documents").select("doc_id", F.array_join(tx.split_places(raw), "|").alias("places"))


@register("list_map_clean", f"""SELECT page_id, md5(array_to_string(list_transform(string_split(html, '/'),
  lambda p: {clean_sql('p')}), '|')) AS parts_md5 FROM pages""")
def list_map_clean(spark, d):
    parts = ls.map_items(F.split("html", "/"), lambda p: tx.clean_text(p, STOPWORDS))
    return table(spark, d, "pages").select("page_id", F.md5(F.array_join(parts, "|")).alias("parts_md5"))


@register("explode_locations", """WITH w AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN [] ELSE string_split(source, 'c') END AS w FROM documents)
SELECT doc_id AS article_id, unnest(w) AS location FROM w UNION ALL SELECT doc_id, NULL FROM w WHERE len(w) = 0""")
def explode_locations(spark, d):
    places = F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.split("source", "c"))
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("article_id"), places.alias("locationsfromarticle"))
    return locations.explode_places(docs)
