"""Texts are read once per step, and short ways give what the plain patterns give."""

from pyspark.sql import functions as F

from articlespark.functions import text as tx
from articlespark.operators import locations, textjobs
from articlespark.plans import articles as job


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_media_type_lowers_a_text_once(spark):
    df = spark.createDataFrame([(1, "A RADIO show"), (2, "plain"), (3, None), (4, "Poll")], "id int, t string")
    got = df.select("id", tx.media_type(F.col("t")).alias("m"))
    assert optimized(got).count("lower(t#") == 1
    assert {r["id"]: r["m"] for r in got.collect()} == {1: "audio", 2: "text", 3: "text", 4: "poll"}


def test_strip_takes_off_what_the_pattern_did(spark):
    ends = [chr(i) for i in [*range(0x00, 0x30), *range(0x80, 0xB0), 0x1680, 0x180E, *range(0x2000, 0x2030), 0x205F, 0x2060, 0x3000, 0xFEFF]]
    rows = [(f"{c}a{c} b{c}{c}",) for c in ends] + [(c,) for c in ends] + [("",), (None,), ("\r\n a\r\n",), (" é ",)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(tx.strip(F.col("t")).alias("now"), F.regexp_replace("t", f"^[{tx.SPACE}]+|[{tx.SPACE}]+$", "").alias("plain"))
    assert "regexp_replace(t#" not in optimized(df.select(tx.strip(F.col("t"))))
    assert got.where("NOT now <=> plain").count() == 0


def test_tags_and_words_as_by_the_patterns(spark):
    df = spark.createDataFrame([("a <b>c</b> d",), ("2 < 3\n> 1",), ("  \t",), ("",), (None,), ("x  y ",)], "t string")
    got = df.select(tx.strip_tags(F.col("t")).alias("tags"), tx.words(F.col("t")).alias("words"))
    assert [tuple(r) for r in got.collect()] == [
        ("a c d", ["a", "<b>c</b>", "d"]), ("2 < 3\n> 1", ["2", "<", "3", ">", "1"]), ("  \t", []), ("", []), (None, None), ("x  y ", ["x", "y"])]


def test_no_struct_is_made_for_each_word_of_a_text(spark):
    df = spark.createDataFrame([(1, "good day", None), (1, "bad", "good"), (2, None, "x")], "id int, a string, b string")
    lexicon = spark.createDataFrame([("good", 1.0, 0.5), ("bad", -1.0, 0.0)], "word string, polarity double, subjectivity double")
    got = textjobs.lexicon_scores(df, "id", {"a": F.col("a"), "b": F.col("b")}, lexicon)
    assert "transform(" not in optimized(got)
    assert sorted(got.select("id", "a_polarity", "b_polarity").collect(), key=str) == [(1, 0.0, 1.0), (1, 0.0, None), (2, None, 0.0)]


def test_only_words_of_names_are_followed(spark):
    names = spark.createDataFrame([("new york",), ("york",), ("isle of man",)], "location string")
    texts = spark.createDataFrame([(1, "new york"), (1, "york isle of man"), (1, "new york"), (2, "isle of a man, new x york"), (None, "york")], "id int, t string")
    found = locations.find_places(texts, "id", "t", names)
    # a token's row holds the token alone until it is known to be part of a name
    assert "Generate posexplode(regexp_extract_all(lower(t#" in optimized(found)
    got = sorted(((r["id"], r["location"]) for r in found.collect()), key=str)
    # texts of one id share their positions
    assert got == [(1, "new york"), (2, "york"), (None, "york")]


def test_ids_are_given_with_one_pass_over_the_rows(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(title):
        seen.add(1)
        return title

    df = spark.createDataFrame([(0, i, f"t{i}", f"NEW YORK (Reuters) - text {i}") for i in range(50)], "file_no int, row_id long, title string, article_text string")
    got = job.prepare(df.withColumn("title", F.udf(look)("title"))).collect()
    assert seen.value == 50 and sorted(r["article_id"] for r in got) == list(range(50))


def test_saved_words_give_what_the_text_gives(spark):
    settings = job.Settings(default_year=2020, stopwords=["the"])
    df = spark.createDataFrame([(1, "The <b>Dogs</b>  ran,\nthe", "The end", ["a dogs"]), (2, "", "x", []), (3, None, None, None)],
                               "article_id int, cleaned_text string, title string, location array<string>")
    lemmas = spark.createDataFrame([("dogs", "dog")], "form string, lemma string")
    plain = job.process_nlp(df, lemmas, settings)
    saved = job.process_nlp(job.with_words(df, settings), lemmas, settings)
    assert plain.columns == saved.columns and job.WORDS not in plain.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, saved.collect()))
    assert {r["article_id"]: r["nlp_text"] for r in saved.collect()} == {1: "dog ran", 2: "", 3: ""}
