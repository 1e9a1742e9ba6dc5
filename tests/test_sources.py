"""Files written and read back."""

import zipfile

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from articlespark import runtime
from articlespark.operators import charts, metrics, ngrams, profile, transformers
from articlespark.sources import readers, stages, writers


def test_csv_keeps_awkward_text(spark, tmp_path):
    data = [('say "hi", ok', "line one\nline two\r\n", " padded ", None), ("back\\slash", "comma,comma", "'", "May 3")]
    df = spark.createDataFrame(data, "title string, text string, subject string, date string")
    writers.save_csv(df, str(tmp_path / "c"))
    got = readers.read_csv(spark, str(tmp_path / "c"), "title string, text string, subject string, date string")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(data, key=str)


def test_zipped_csv(spark, tmp_path):
    for i in range(2):
        with zipfile.ZipFile(tmp_path / f"a{i}.csv.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("a.csv", 'title,text,subject\n"x, y","two\nlines",\n' + f"t{i},b,s\n")
    got = readers.read_zipped_csv(spark, str(tmp_path), ["title", "text", "subject", "date"]).collect()
    assert sorted(tuple(r) for r in got if r["subject"]) == [("t0", "b", "s", None), ("t1", "b", "s", None)]
    assert [tuple(r) for r in got if not r["subject"]] == [("x, y", "two\nlines", None, None)] * 2


def test_by_year_drops_rows_without_year(spark, tmp_path):
    df = spark.createDataFrame([(2016, "a"), (2017, "b"), (None, "c")], "year int, v string")
    writers.save_by_year(df, str(tmp_path / "y"))
    assert sorted(p.name for p in (tmp_path / "y").iterdir() if p.name.startswith("year")) == ["year=2016", "year=2017"]


def test_text_fragments(spark, tmp_path):
    df = spark.createDataFrame([("all", "ab", 3), ("all", "c", 1)], "subset string, term string, weight bigint")
    writers.save_text(ngrams.repeat_terms(df).coalesce(1).sortWithinPartitions("term"), str(tmp_path / "t"), ["subset"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "t" / "subset=all").glob("part-*")))
    assert text == "ab ab ab  c  "


def test_stage_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "s")
    assert stages.stage(spark, path, build, reuse=True).count() == 3
    assert stages.stage(spark, path, build, reuse=True).count() == 3
    assert len(calls) == 1
    stages.stage(spark, path, build)
    assert len(calls) == 2


def test_torn_stage_is_built_again(spark, tmp_path):
    path = tmp_path / "s"
    spark.range(5).repartition(2).write.parquet(str(path))
    (path / "_SUCCESS").unlink()
    assert stages.stage(spark, str(path), lambda: spark.range(3), reuse=True).count() == 3
    assert stages.stage(spark, str(path), lambda: spark.range(9), reuse=True).count() == 3


def test_a_large_year_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(20_000).select(F.when(F.col("id") < 50, 2015).otherwise(2016).alias("year"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.save_by_year(df, str(tmp_path / "y"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {y: len(list((tmp_path / "y" / f"year={y}").glob("part-*"))) for y in (2015, 2016)}
    assert files[2015] <= 2 < files[2016]
    assert spark.read.parquet(str(tmp_path / "y")).count() == 20_000


def test_flags_close_over_earlier_stages():
    flags = {"useprecombineddata": False, "usepostnlpdata": False, "useprelocationdata": False,
             "useprelocationenricheddata": True}
    assert all(stages.resolve_flags(flags).values())
    assert stages.resolve_flags({"usepostnlpdata": True, "other": False}) == {
        "usepostnlpdata": True, "useprecombineddata": True, "other": False}
    assert stages.resolve_flags({}) == {}


class Conf:
    """Stands for a session with or without the folder setting."""

    def __init__(self, folder, master):
        self.folder, self.master = folder, master
        self.conf = self.sparkContext = self

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" and self.folder else default


def test_shared_folder_comes_from_the_session(tmp_path):
    from articlespark import runtime
    assert runtime.shared_path(Conf(str(tmp_path), "yarn"), "x").startswith(f"{tmp_path}/x-")
    assert runtime.shared_path(Conf(None, "local[2]"), "x") != runtime.shared_path(Conf(None, "local[2]"), "x")
    with pytest.raises(ValueError):
        runtime.shared_path(Conf(None, "yarn"), "x")


def test_materialize(spark):
    from articlespark import runtime
    out = runtime.materialize(spark.range(4).withColumn("v", F.lit("a")), "t")
    assert out.count() == 4 and out.columns == ["id", "v"]


def test_unknown_model_kind(spark):
    from articlespark.plans import textmodel
    with pytest.raises(ValueError):
        textmodel.train(spark.range(1), "clustering")


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    for name, values in (("b", range(100, 2600)), ("a", range(3)), ("c", [9000])):
        (tmp_path / f"{name}.csv").write_text("v\n" + "".join(f"{v}\n" for v in values))
    rows = readers.numbered(spark.read.schema("v int").option("header", True).csv(str(tmp_path)).select("v"))
    assert [r["v"] for r in rows.orderBy("ord").collect()] == [*range(3), *range(100, 2600), 9000]


def test_more_test_files_keep_their_labels(spark, tmp_path):
    files = {"fake": "title,text,subject,date\na,b,c,d\n", "true": "title,text,subject,date\ne,f,g,h\n",
             "test": "title,text,subject,date,Column1,subject2,label\ni,j,k,l,,,1\n", "more": "label,Unnamed: 0,title,text,subject,date\n0,7,m,n,o,p\n"}
    for name, content in files.items():
        (tmp_path / f"{name}.csv").write_text(content)
    fake, true, test = readers.read_raw_articles(spark, *[str(tmp_path / f"{n}.csv") for n in ("true", "fake", "test")], [str(tmp_path / "more.csv")])
    assert fake.first()["title"] == "a" and true.first()["title"] == "e"
    assert {(r["title"], r["label"]) for r in test.collect()} == {("i", 1), ("m", 0)} and "Unnamed: 0" not in test.columns


def test_one_year_is_written_again(spark, tmp_path):
    first = spark.createDataFrame([(2016, "a"), (2017, "b")], "year int, v string")
    writers.save_by_year(first, str(tmp_path / "y"))
    writers.save_by_year(first.filter("year = 2017").withColumn("v", F.lit("c")), str(tmp_path / "y"))
    assert {(r["year"], r["v"]) for r in spark.read.parquet(str(tmp_path / "y")).collect()} == {(2016, "a"), (2017, "c")}
    writers.save_by_year(first.filter("year = 2016"), str(tmp_path / "y"), only_given=False)
    assert [r["year"] for r in spark.read.parquet(str(tmp_path / "y")).collect()] == [2016]


def test_scratch_tables_go(spark):
    scratch = runtime.Scratch()
    with scratch:
        kept = runtime.materialize(spark.range(3), "kept")
    other = runtime.materialize(spark.range(4), "other")
    scratch.free(spark)
    with pytest.raises(Exception):
        spark.read.schema("id long").parquet(kept.written_to).count()
    assert other.count() == 4
    runtime.discard(other)
    with pytest.raises(Exception):
        spark.read.schema("id long").parquet(other.written_to).count()


def test_cleaning_stages_are_saved_with_their_pipeline(spark, tmp_path):
    rows = spark.createDataFrame([("It's ON!", None), (None, "x, y")], "a string, b string")
    stages_ = [transformers.TextCleaning(inputCol="a", outputCol="one"), transformers.TextPreprocessor(inputCols=["a", "b"], outputCol="two", separator="|")]
    PipelineModel(stages_).write().overwrite().save(str(tmp_path / "p"))
    got = PipelineModel.load(str(tmp_path / "p")).transform(rows).select("one", "two").collect()
    assert sorted(map(tuple, got)) == [("", "|x y"), ("its on", "its on|")]


def test_counts_of_the_write_and_approximate_profiles(spark):
    rows = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 != 0, F.col("id") * 1.0).alias("v"), (F.col("id") % 2).alias("label"))
    steps = {"given": F.col("v").isNotNull(), "large": F.col("v") > 500}
    watched, seen = profile.watched(rows, steps)
    runtime.materialize(watched, "rows")
    assert sorted(profile.watched_counts(spark, seen, steps).collect()) == sorted(profile.stage_counts(rows, steps).collect())
    exact, near = (profile.describe(rows, ["v"], approximate=a).first() for a in (False, True))
    assert (near["count"], near["min"], near["max"], near["mean"]) == (exact["count"], exact["min"], exact["max"], pytest.approx(exact["mean"]))
    assert all(abs(near[q] - exact[q]) <= 2 for q in ("p25", "p50", "p75"))
    boxes = {r["label"]: r for r in charts.box(rows, "v", approximate=True).collect()}
    assert boxes[0]["low"] == 2.0 and boxes[1]["high"] == 997.0 and boxes[0]["n_rows"] + boxes[1]["n_rows"] == 666


def test_summary_of_a_report(spark):
    rows = [(0, 0.0)] * 5 + [(0, 1.0)] + [(1, 1.0)] * 3 + [(1, 0.0)]
    got = metrics.summary(spark.createDataFrame(rows, "label int, prediction double")).first()
    assert got["accuracy"] == pytest.approx(0.8) and got["recall"] == pytest.approx(0.8) and got["precision"] == pytest.approx(0.8)
