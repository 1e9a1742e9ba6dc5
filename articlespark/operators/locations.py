"""Place mentions: gazetteer, extraction, enrichment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..runtime import materialize, small
from ..sources.readers import require_columns, trim_headers
from .aggregates import centroid
from .joins import first_match, update_from

CITY_COLUMNS = ["city_ascii", "admin_name", "country", "iso2", "iso3", "lat", "lng"]
STATE_COLUMNS = ["Place Name", "State Capital", "Country", "Latitude", "Longitude"]
REGION_COLUMNS = ["country", "sub_region", "continent", "code_2", "code_3"]
COUNTRY_LEVEL = "Country level only"


def gazetteer(cities: DataFrame, states: DataFrame, regions: DataFrame) -> DataFrame:
    """Lower-cased, trimmed, distinct names from nine lookup columns, as ``location``."""
    parts = [(cities, ["city_ascii", "country", "iso2", "iso3"]),
             (states, ["Place Name", "State Capital"]),
             (regions, ["country", "sub_region", "continent"])]
    columns = [df.select(F.explode(F.array(*[F.col(f"`{c}`") for c in cols])).alias("location"))
               for df, cols in parts]
    every = reduce(DataFrame.unionByName, columns)
    return every.select(tx.strip(F.lower("location")).alias("location")).dropna().distinct()


def find_places(df: DataFrame, id_col: str, text: str, names: DataFrame, name_col: str = "location") -> DataFrame:
    """Distinct (id, location) for the gazetteer names in each text, as whole words.

    Text and names are compared as lists of words, so punctuation in either makes no difference; of
    names with the same words, the last in order stands for all. Reading left to right, the longest name
    at a position wins and the search goes on behind it. Only tokens that are words of some name are kept, with
    their positions; each becomes a row holding the few kept tokens that follow it without a gap. It meets the lengths of
    the names that open with its token, one row per opening word, and then the names by equality, so that a word that
    opens many names does not multiply its rows. The choice between overlapping names looks at the matches of a single article.
    """
    def in_words(c: Column) -> Column:
        return F.regexp_extract_all(F.lower(c), F.lit(f"([{tx.WORD}]+)"), 1)

    entries = materialize(
        names.select(F.lower(name_col).alias("location"), in_words(F.col(name_col)).alias("_tokens"))
        .filter(F.size("_tokens") > 0).groupBy("_tokens").agg(F.max("location").alias("location"))
        .select("location", F.get("_tokens", F.lit(0)).alias("_first"), F.size("_tokens").alias("_len"),
                F.array_join("_tokens", " ").alias("_name"), "_tokens"), "names")
    longest = entries.agg(F.max("_len")).first()[0] or 1
    openers = entries.groupBy("_first").agg(F.sort_array(F.collect_set("_len")).alias("_lens"))
    parts = entries.select(F.explode("_tokens").alias("_word")).distinct()

    def runs(kept: Column) -> Column:
        return F.transform(kept, lambda t, i: F.struct(t["pos"].alias("pos"), t["_word"].alias("_first"), F.transform(
            F.filter(F.slice(kept, i + 1, longest), lambda x, k: x["pos"] == t["pos"] + k), lambda x: x["_word"]).alias("ahead")))

    # positions are those of a text, of which an id may have several
    kept = (df.select(id_col, F.xxhash64(text).alias("_text"), F.posexplode(in_words(F.col(text))).alias("pos", "_word"))
            .join(small(parts), "_word").groupBy(id_col, "_text").agg(F.sort_array(F.collect_list(F.struct("pos", "_word"))).alias("_all"))
            .select(id_col, F.filter("_all", lambda t, i: (i == 0) | (F.get("_all", i - 1)["pos"] != t["pos"])).alias("_kept")))
    spots = kept.select(id_col, F.explode(runs(F.col("_kept"))).alias("s")).select(id_col, "s.*")
    tried = (spots.join(small(openers), "_first")
             .select(id_col, "pos", "ahead", F.explode("_lens").alias("_len")).filter(F.size("ahead") >= F.col("_len"))
             .select(id_col, "pos", F.array_join(F.slice("ahead", F.lit(1), F.col("_len")), " ").alias("_name")))
    hits = (tried.join(small(entries.drop("_first", "_tokens")), "_name")
            .select(id_col, F.struct((-F.col("pos")).alias("back"), F.col("_len").alias("len"), "location").alias("hit")))
    free = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("found"))
    # in the order of position, the longest first
    walked = (hits.groupBy(id_col).agg(F.sort_array(F.collect_list("hit"), asc=False).alias("hits"))
              .select(id_col, F.aggregate("hits", free, lambda acc, h: F.when(
                  -h["back"] >= acc["next"],
                  F.struct((h["len"] - h["back"]).alias("next"),
                           F.array_append(acc["found"], h["location"]).alias("found"))).otherwise(acc)).alias("w")))
    return walked.select(id_col, F.explode(F.array_distinct("w.found")).alias("location"))


def with_places(df: DataFrame, id_col: str, found: DataFrame, name: str = "locationsfromarticle") -> DataFrame:
    """Attach the found places as a sorted array; articles without any get an empty one."""
    lists = found.groupBy(id_col).agg(F.sort_array(F.collect_set("location")).alias(name))
    return (df.join(lists, id_col, "left")
            .withColumn(name, F.coalesce(F.col(name), F.array().cast("array<string>"))))


def explode_places(df: DataFrame, id_col: str = "article_id", places: str = "locationsfromarticle") -> DataFrame:
    """One row per article and place; an empty list gives one row with a null place."""
    return df.select(id_col, F.explode_outer(places).alias("location"))


def normalize_lookup(df: DataFrame, names: dict[str, str], extra: Sequence[str] = ()) -> DataFrame:
    """Selected columns under new names, rows with any null dropped, strings in lower case."""
    picked = df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()], *extra).dropna()
    return picked.select(*[F.lower(f.name).alias(f.name) if isinstance(f.dataType, T.StringType)
                           else F.col(f.name) for f in picked.schema])


def lookups(cities: DataFrame, states: DataFrame, regions: DataFrame, order: str = "ord",
            na_as_null: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Normalised city, state and region tables; fails if expected columns are missing.

    ``order`` is a column giving the file order. ``na_as_null`` reads the code ``NA`` as missing,
    which drops Namibia."""
    cities, states, regions = trim_headers(cities), trim_headers(states), trim_headers(regions)
    require_columns(cities, CITY_COLUMNS)
    require_columns(states, STATE_COLUMNS)
    require_columns(regions, REGION_COLUMNS)
    if na_as_null:
        cities = cities.withColumns({c: F.nullif(c, F.lit("NA")) for c in ("iso2", "iso3")})
        regions = regions.withColumns({c: F.nullif(c, F.lit("NA")) for c in ("code_2", "code_3")})
    city = normalize_lookup(cities, dict(zip(CITY_COLUMNS, [
        "city", "state", "country", "iso2", "iso3", "latitude", "longitude"])), [order])
    state = normalize_lookup(states, dict(zip(STATE_COLUMNS, [
        "state", "capital", "country", "latitude", "longitude"])), [order])
    region = normalize_lookup(regions, dict(zip(REGION_COLUMNS, [
        "country", "subcontinent", "continent", "iso2", "iso3"])), [order])
    return city, state, region


def region_by_country(regions: DataFrame, order: str = "ord") -> DataFrame:
    return first_match(regions, "country", order).drop(order)


def attach_region(df: DataFrame, regions: DataFrame, order: str = "ord") -> DataFrame:
    """Subcontinent, continent and iso codes by country name; a found row's codes win."""
    found = region_by_country(regions, order).select(
        "country", "subcontinent", "continent", F.col("iso2").alias("_iso2"), F.col("iso3").alias("_iso3"))
    out = df.join(small(found), "country", "left")
    for code in ("iso2", "iso3"):
        old = F.col(code) if code in df.columns else F.lit(None).cast("string")
        out = out.withColumn(code, F.coalesce(F.col(f"_{code}"), old)).drop(f"_{code}")
    return out


def enrich_places(places: DataFrame, city: DataFrame, state: DataFrame, region: DataFrame,
                  order: str = "ord") -> DataFrame:
    """City, state, country, region, codes and position for each distinct place name.

    Tried in turn: city, US state or its capital, country name, two-letter code, three-letter
    code; the first hit decides and a miss leaves all columns null. Each lookup is reduced to one
    row per key and its centroids are computed once; the lookups are merged and written as one table by name, which
    is all that places are probed against.
    """
    c = F.col
    names = ["city", "state", "country", "subcontinent", "continent", "latitude", "longitude", "iso2", "iso3"]
    kinds = {"latitude": "double", "longitude": "double"}

    def hit(priority: int, **cols) -> list[Column]:
        return [F.lit(priority).alias("priority"), F.struct(*[
            (cols[n] if n in cols else F.lit(None)).cast(kinds.get(n, "string")).alias(n) for n in names]).alias("hit")]

    by_name = region_by_country(region, order).select(
        c("country").alias("r_country"), c("subcontinent").alias("r_sub"), c("continent").alias("r_cont"),
        c("iso2").alias("r_iso2"), c("iso3").alias("r_iso3"))

    def middle(key: str) -> DataFrame:
        return centroid(city, key).select(c(key).alias("m_key"), c("latitude").alias("m_lat"), c("longitude").alias("m_lng"))

    tables = [first_match(city, "city", order).join(by_name, c("country") == c("r_country"), "left").select(
        c("city").alias("k"), *hit(
            1, city=c("city"), state=c("state"), country=c("country"), subcontinent=c("r_sub"), continent=c("r_cont"),
            latitude=c("latitude"), longitude=c("longitude"), iso2=F.coalesce("r_iso2", "iso2"),
            iso3=F.coalesce("r_iso3", "iso3")))]
    # a row is found by its state or by its capital; the earlier row wins
    either = state.select(F.explode(F.array_distinct(F.array("state", "capital"))).alias("k"),
                          "state", "capital", "country", order)
    tables.append(
        first_match(either, "k", order).join(by_name, c("country") == c("r_country"), "left")
        .join(middle("state"), c("state") == c("m_key"), "left").select("k", *hit(
            2, city=c("capital"), state=c("state"), country=c("country"), subcontinent=c("r_sub"), continent=c("r_cont"),
            latitude=c("m_lat"), longitude=c("m_lng"), iso2=c("r_iso2"), iso3=c("r_iso3"))))
    for priority, key in ((3, "country"), (4, "iso2"), (5, "iso3")):
        tables.append(
            first_match(region.withColumn("k", c(key)), "k", order).join(middle(key), c(key) == c("m_key"), "left")
            .select("k", *hit(
                priority, city=F.lit(COUNTRY_LEVEL), country=c("country"), subcontinent=c("subcontinent"),
                continent=c("continent"), latitude=c("m_lat"), longitude=c("m_lng"), iso2=c("iso2"), iso3=c("iso3"))))

    # one merged lookup, written once and measured from there
    best = materialize(reduce(DataFrame.unionByName, tables).groupBy("k").agg(F.min_by("hit", "priority").alias("_best")), "lookup")
    keyed = places.withColumn("location", F.lower("location")).withColumn("k", c("location"))
    return keyed.join(small(best), "k", "left").select(*places.columns, "_best.*")


def missing_places(places: DataFrame) -> DataFrame:
    """Places worth a fallback lookup: no position and not ignored."""
    return places.filter(F.col("latitude").isNull() & (F.col("ignore") != 1))


def fill_missing(places: DataFrame, answers: DataFrame) -> DataFrame:
    """Position, and continent, country and state from the address, for the places that ``missing_places`` asks for.

    ``answers`` is the geocoder's table (location, latitude, longitude, address), a row per place; answers for other places do not count,
    and what an answer lacks stays as it was."""
    continent, country, state = tx.address_parts(F.col("address"))
    asked = (answers.select("location", "latitude", "longitude", continent.alias("continent"), country.alias("country"), state.alias("state"))
             .join(missing_places(places).select("location"), "location", "left_semi"))
    return update_from(places, asked, "location", ["latitude", "longitude", "continent", "country", "state"])


def drop_ignored(places: DataFrame) -> DataFrame:
    """Null flags stay, as a comparison with a missing value is true in pandas."""
    return places.filter(~F.col("ignore").eqNullSafe(F.lit(1))).drop("ignore")


def place_counts(places: DataFrame) -> DataFrame:
    """Mentions over all articles, most frequent first."""
    return (places.dropna(subset=["location"]).groupBy("location").agg(F.count("*").alias("count"))
            .orderBy(F.desc("count"), "location"))
