"""From raw article tables to cleaned, dated, scored and located articles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as dt
from ..functions import lists as ls
from ..functions import measures as ms
from ..functions import text as tx
from ..operators import calendar, locations, ordering, rows, textjobs
from ..operators.aggregates import count_by
from ..operators.joins import member_flag
from ..runtime import CODEC, Scratch, discard, materialize, release, shuffle_width
from ..sources.stages import Buckets, resolve_flags, stage, stage_over

WORKING_COLUMNS = ["Column1", "subject2", "count", "date_str", "media_type_title", "media_type_article", "date"]
FINAL_DROPS = ["nlp_textloc", "source", "location", "nlp_location"]
#: the clean words of ``cleaned_text``, separated by single spaces
WORDS = "_words"
FILE_ORDER = {"true": 0, "fake": 1, "test_data": 2}


@dataclass(frozen=True)
class Settings:
    """Choices of the article job; the lexicon tables are given by the caller."""

    default_year: int
    stopwords: Sequence[str] = ()
    strip_article_punct: bool = False
    try_date_formats: bool = False
    #: buckets of the stages, by article; None takes as many as the session has shuffle partitions
    buckets: int | None = None


def combine(true: DataFrame, fake: DataFrame, test: DataFrame) -> DataFrame:
    """The three sources with their labels (real 1, dubious 0) and origin, in load order.

    Each source needs a unique ``row_id`` in file order; see ``sources.readers.numbered``."""
    every = rows.union_sources(rows.tag_origin(true, "true", 1), rows.tag_origin(fake, "fake", 0),
                               rows.tag_origin(test, "test_data"))
    return every.withColumn("file_no", rows.remap(F.col("file"), FILE_ORDER))


def clean_combined(df: DataFrame, settings: Settings) -> DataFrame:
    """First copy of each text, titles filled, blank rows dropped, media type assigned."""
    df = ordering.keep_first(df, "text", ["file_no", "row_id"])
    df = rows.drop_blank(rows.drop_null(rows.backfill_title(df), ["title", "text"]), ["title", "text"])
    df = rows.rename_columns(df, {"text": "article_text"})
    for c in ("title", "article_text"):
        cleaned = tx.strip_punct(F.col(c)) if settings.strip_article_punct else F.col(c)
        df = df.withColumn(c, tx.strip(cleaned))
    media = tx.combined_media_type(tx.media_type(F.col("title")), tx.media_type(F.col("article_text")))
    return df.withColumn("media_type", media)


def add_dates(spark: SparkSession, df: DataFrame, settings: Settings) -> DataFrame:
    """Clean date, its raw text parts, calendar features and holidays."""
    month, day, year = dt.raw_date_parts(F.col("date"))
    clean = dt.date_with_fallback(dt.parse_date(F.col("date"), settings.default_year), F.col("article_text"),
                                  F.col("title"), settings.try_date_formats)
    df = df.withColumns({"month_raw": month, "day_raw": day, "year_raw": year, "date_clean": clean})
    df = df.withColumns({"month": F.month("date_clean"), "day": F.dayofmonth("date_clean"),
                         "year": F.year("date_clean"), **dt.date_features(F.col("date_clean"))})
    return calendar.with_holidays(df, "date_clean", calendar.us_holidays(spark))


def classify_and_combine(spark: SparkSession, true: DataFrame, fake: DataFrame, test: DataFrame,
                         settings: Settings) -> DataFrame:
    df = add_dates(spark, clean_combined(combine(true, fake, test), settings), settings)
    return rows.drop_columns(df, WORKING_COLUMNS)


def number(df: DataFrame) -> DataFrame:
    """Article ids in load order."""
    # dealing out ranges reads its rows twice, the first time for their limits
    classified = materialize(df, "classified", CODEC)
    release(df.sparkSession)
    df = ordering.dense_ids(classified, ["file_no", "row_id"], "article_id", CODEC).drop("file_no", "row_id")
    discard(classified)
    release(df.sparkSession)
    return df


def prepare(df: DataFrame) -> DataFrame:
    """Article ids in load order, dateline split into places and agency, lengths."""
    return describe(number(df))


def describe(df: DataFrame) -> DataFrame:
    """Dateline split into places and agency, lengths."""
    source, rest = tx.dateline(F.col("article_text"))
    df = df.withColumns({"source": source, "cleaned_text": rest})
    df = rows.fill_defaults(df, {"source": "UNKNOWN (Unknown)"}, empty_too=["source"])
    df = rows.trim_strings(df)
    place, name = tx.source_parts(F.col("source"))
    return df.withColumns({
        "location": tx.split_places(place),
        "source_name": F.coalesce(name, F.lit("Unknown")),
        "title_length": F.length("title"),
        "text_length": F.length("cleaned_text"),
    })


def with_words(df: DataFrame, settings: Settings) -> DataFrame:
    """Add the words of the text that ``process_nlp`` reads twice, to be saved with it."""
    return df.withColumn(WORDS, F.array_join(tx.clean_tokens(F.col("cleaned_text"), settings.stopwords), " "))


def process_nlp(df: DataFrame, lemmas: DataFrame, settings: Settings) -> DataFrame:
    """Cleaned text, title and places, and text and places together; words are mapped through the (form, lemma) table."""
    def tokens(c):
        return tx.clean_tokens(c, settings.stopwords)

    def mapped(words):
        return F.coalesce(F.array_join(tx.replace_words(words, F.col("_lemmas")), " "), F.lit(""))

    if WORDS not in df.columns:
        df = with_words(df, settings)
    text = F.array_remove(F.split(WORDS, " "), "")
    none = F.array().cast("array<string>")
    every = F.concat(*[F.coalesce(a, none) for a in (
        text, tokens(F.col("title")), tokens(F.array_join("location", " ")))])
    df = textjobs.with_lemmas(df, "article_id", every, lemmas)
    df = df.withColumns({"nlp_text": mapped(text), "nlp_title": mapped(tokens(F.col("title"))),
                         "nlp_location": ls.map_items(F.col("location"), lambda c: mapped(tokens(c)))}).drop("_lemmas", WORDS)
    return df.withColumn("nlp_textloc", text_and_places())


def text_and_places() -> Column:
    return tx.join_list(F.col("nlp_text"), F.col("nlp_location"))


def apply_sentiment(df: DataFrame, lexicon: DataFrame) -> DataFrame:
    df = textjobs.lexicon_scores(df, "article_id", {"article": F.col("nlp_text"), "title": F.col("nlp_title")}, lexicon)
    df = df.withColumns(ms.sentiment_mix())
    return df.withColumns({f"sentiment_{kind}": tx.sentiment_label(F.col(f"{kind}_polarity"),
                                                                   F.col(f"{kind}_subjectivity"))
                           for kind in ("article", "title", "overall")})


@dataclass
class Places:
    """Article places, their counts and the enriched distinct places."""

    mentions: DataFrame
    counts: DataFrame
    unique: DataFrame


def locate(df: DataFrame, cities: DataFrame, states: DataFrame, regions: DataFrame) -> DataFrame:
    """Articles with their gazetteer places in ``locationsfromarticle``."""
    names = locations.gazetteer(cities, locations.trim_headers(states), regions)
    found = locations.find_places(df, "article_id", "nlp_textloc", names)
    return locations.with_places(df, "article_id", found)


def place_tables(located: DataFrame, cities: DataFrame, states: DataFrame, regions: DataFrame,
                 answers: DataFrame | None = None) -> Places:
    """Mentions, their counts, and the distinct places enriched from the lookups and, where these know nothing, from a geocoder's answers."""
    mentions = locations.explode_places(located)
    counts = count_by(mentions, ["article_id", "location"])
    distinct = mentions.select("location").dropna().distinct()
    known = cities.select(F.lower("city_ascii").alias("city"))
    flagged = member_flag(distinct, "location", known, "city")
    city, state, region = locations.lookups(cities, states, regions)
    unique = locations.enrich_places(flagged, city, state, region)
    if answers is not None:
        unique = locations.fill_missing(materialize(unique, "places"), answers)
    return Places(mentions, counts, unique)


def finalize(df: DataFrame) -> DataFrame:
    df = rows.fill_defaults(df, {"subject": "Unknown"})
    return rows.drop_null(rows.drop_columns(df, FINAL_DROPS), ["cleaned_text"])


@dataclass(frozen=True)
class Inputs:
    """Raw sources and lookup tables of the article job."""

    true: DataFrame
    fake: DataFrame
    test: DataFrame
    cities: DataFrame
    states: DataFrame
    regions: DataFrame
    lexicon: DataFrame
    lemmas: DataFrame
    #: a geocoder's answers (location, latitude, longitude, address) for places the lookups do not know
    answers: DataFrame | None = None


def build_articles(spark: SparkSession, inputs: Inputs, folder: str, settings: Settings,
                   flags: Mapping[str, bool] | None = None) -> tuple[DataFrame, Places]:
    """The whole article job. Every stage is saved below ``folder``; ``flags`` choose which saved
    stages are used again. Returns the final articles and the place tables.

    Stages lie in buckets of ``article_id``. The texts are dealt to them once, by the first; later stages, the mentions and joins
    between them move only what is new, such as lemmas, scores and places, and save only that. What the first stage was made from is deleted
    once it is saved."""
    use = resolve_flags(flags or {})
    buckets = Buckets("article_id", settings.buckets or shuffle_width(spark))

    def saved_stage(name, flag, base, build, **options):
        return stage_over(spark, f"{folder}/{name}", base, build, buckets, bool(use.get(flag)), **options)

    with Scratch() as scratch:
        # one text is dealt out, those made of it follow in its bucket
        combined = stage(spark, f"{folder}/combined", lambda: with_words(describe(number(classify_and_combine(
            spark, inputs.true, inputs.fake, inputs.test, settings)).repartition(buckets.number, buckets.key)), settings),
            bool(use.get("useprecombineddata")), buckets)
    scratch.free(spark)
    release(spark)
    nlp = saved_stage("nlp", "usepostnlpdata", combined, lambda: process_nlp(combined, inputs.lemmas, settings),
                      derived={"nlp_textloc": text_and_places()}, dropped=[WORDS])
    scored = saved_stage("scored", "useprelocationdata", nlp, lambda: apply_sentiment(nlp, inputs.lexicon))
    located = saved_stage("located", "useprelocationenricheddata", scored, lambda: locate(
        scored, inputs.cities, inputs.states, inputs.regions))
    tables = place_tables(located, inputs.cities, inputs.states, inputs.regions, inputs.answers)
    mentions = stage(spark, f"{folder}/article_locations", lambda: tables.mentions, buckets=buckets)
    unique = stage(spark, f"{folder}/unique_locations", lambda: tables.unique)
    return finalize(located), Places(mentions, tables.counts, unique)
