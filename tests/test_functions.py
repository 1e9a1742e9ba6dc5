"""Literal rows for the places where the engines or libraries differ."""

import datetime as dtm

import pytest
from pyspark.sql import functions as F

from articlespark.functions import dates as dt
from articlespark.functions import lists as ls
from articlespark.functions import measures as ms
from articlespark.functions import text as tx


def one(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw, want", [
    ("December 31, 2017", "2017-12-31"), ("Dec 5, 16", "2016-12-05"), ("May 3", "2021-05-03"),
    (None, None), ("31-Dec-17", None), ("2017-02-01", None), ("Feb 2017", None),
    ("February 30, 2017", None), ("Smarch 3, 2017", None), ("Jan 031, 2017", None), ("Jan 1, 20175", None), ("Jan 1, 1500", None)])
def test_parse_date(spark, raw, want):
    got = one(spark, raw, lambda c: dt.parse_date(c, 2021))
    assert got == (dtm.date.fromisoformat(want) if want else None)


def test_date_fallback_order(spark):
    df = spark.createDataFrame([
        (None, "at 2016-05-04 and 2017-01-01", "2018-01-01"), (None, "none 2016-13-45", "on 2018-02-03"),
        (None, "31 12 2019", "x"), (dtm.date(2001, 1, 1), "2016-05-04", "x")], "d date, a string, t string")
    plain = [r[0].isoformat() for r in df.select(dt.date_with_fallback(F.col("d"), F.col("a"), F.col("t"))).collect()]
    tried = [r[0].isoformat() for r in df.select(dt.date_with_fallback(F.col("d"), F.col("a"), F.col("t"), True)).collect()]
    assert plain == ["2016-05-04", "2018-02-03", "2000-02-01", "2001-01-01"]
    assert tried == ["2016-05-04", "2018-02-03", "2019-12-31", "2001-01-01"]


def test_iso_week_and_weekend(spark):
    df = spark.createDataFrame([(dtm.date(2021, 1, 3),)], "d date")
    f = dt.date_features(F.col("d"))
    assert tuple(df.select(f["week_of_year"], f["day_of_week"], f["is_weekend"], f["is_weekday"]).first()) == (53, "Sunday", 1, 0)


@pytest.mark.parametrize("value, want", [
    (0.125, 0.12), (0.375, 0.38), (2.675, 2.68), (0.285, 0.28), (1.005, 1.0), (-0.125, -0.12)])
def test_round_half_even(spark, value, want):
    assert one(spark, value, ms.round_half_even, "double") == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("value, want", [(5, 0), (15, 20), (25, 20), (35, 40), (104, 100), (105, 100)])
def test_round_to_tens(spark, value, want):
    assert one(spark, value, ms.round_to_tens, "int") == want


def test_variation_of_zero_is_zero(spark):
    df = spark.createDataFrame([(0.5, 0.0), (0.5, 0.25)], "d double, b double")
    assert [r[0] for r in df.select(ms.variation(F.col("d"), F.col("b"))).collect()] == [0.0, 2.0]


def test_dateline(spark):
    df = spark.createDataFrame([("NEW YORK/LONDON (Reuters) - Body",), ("No dateline",),
                                ("A (B) - x A (B) - y",)], "v string")
    source, rest = tx.dateline(F.col("v"))
    assert [tuple(r) for r in df.select(source, rest).collect()] == [
        ("NEW YORK/LONDON (Reuters) -", "Body"), ("", "No dateline"), ("A (B) -", "x  y")]


def test_source_parts(spark):
    df = spark.createDataFrame([("NEW YORK/LONDON (Reuters) -",), ("UNKNOWN (Unknown)",)], "v string")
    place, name = tx.source_parts(F.col("v"))
    assert [(r[0], r[1]) for r in df.select(tx.split_places(place), name).collect()] == [
        (["NEW YORK", "LONDON"], "Reuters"), (["UNKNOWN"], "Unknown")]


def test_word_classes_are_unicode(spark):
    assert one(spark, "Ünï-co_dé, №1 a", tx.word_tokens) == ["ünï", "co_dé"]
    assert one(spark, "é’s “x”", tx.strip_punct) == "és x"


@pytest.mark.parametrize("text, want", [
    ("Fixed", "twitter"), ("Listen to VIDEO", "video"), ("a big thing", "instagram"), ("plan", "text"), (None, "text")])
def test_media_type(spark, text, want):
    assert one(spark, text, tx.media_type) == want


def test_subjectivity_band_keeps_the_spelling(spark):
    assert one(spark, 0.1, tx.subjectivity_band, "double") == "higly objective"
    assert one(spark, None, tx.subjectivity_band, "double") == "higly objective"


def test_contractions(spark):
    got = one(spark, "Didn’t 'quote' abc123 über it's the o'clock's end", lambda c: tx.contraction_tokens(c, ["the"]))
    assert got == ["didn't", "quote", "it's", "end"]


@pytest.mark.parametrize("text, want", [
    ("['a', 'b']", ["a", "b"]), ("[]", []), (None, []), ("['a', broken", []), ("[\"it's\", 'b']", ["it's", "b"]),
    (r"['a\'b']", ["a'b"]), ("not a list", []), ("['a',]", ["a"])])
def test_parse_list(spark, text, want):
    assert one(spark, text, ls.parse_list) == want


def test_list_count(spark):
    df = spark.createDataFrame([([],), (["a", "b"],), (None,)], "v array<string>")
    rows = df.select(ms.list_count(F.col("v")), ms.list_count(F.col("v"), True)).collect()
    assert [tuple(r) for r in rows] == [(0, 1), (2, 2), (0, 0)]


def test_run_lengths(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],), (["x"],)], "v array<string>")
    got = [[tuple(x) for x in r[0]] for r in df.select(ls.run_lengths(F.col("v"))).collect()]
    assert got == [[("a", 1), ("b", 2)], [], [("x", 1)]]


def test_phrases(spark):
    df = spark.createDataFrame([(["a", "the", "of", "b"],), (["a"],), ([],)], "v array<string>")
    two = [r[0] for r in df.select(ls.phrases(F.col("v"), 2, ["the", "of"])).collect()]
    three = [r[0] for r in df.select(ls.phrases(F.col("v"), 3)).collect()]
    assert two == [["a the", "of b"], [], []]
    assert three == [["a the of", "the of b"], [], []]


def test_address(spark):
    df = spark.createDataFrame([("10 Main St, Ohio, USA",), ("USA",), ("",), (None,)], "v string")
    continent, country, state = tx.address_parts(F.col("v"))
    assert [tuple(r) for r in df.select(continent, country, state).collect()] == [
        ("10 Main St", "USA", "Ohio"), (None, "USA", None), (None, None, None), (None, None, None)]
    assert one(spark, "x, provence-alpes 13001, France", tx.address_state) is None
    assert one(spark, "x, NY 10001, USA", tx.address_state) == "Ny"
    assert one(spark, "new-york o'neil", tx.title_case) == "New-York O'Neil"


def test_blank_knows_unicode_spaces(spark):
    assert one(spark, "  \t", tx.is_blank) is True
    assert one(spark, "  x ", tx.strip) == "x"
