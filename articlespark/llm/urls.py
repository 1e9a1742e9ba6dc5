"""URL filter: site rules, and gradient-boosted trees on lexical features where no rule fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize

# fixed values: (rule, verdict), a rule being a host and the start of a path
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
# The trees are fitted on this many labelled URLs, those with the smallest hashes.
TRAINING_ROWS = 20_000

LEXICAL = ("length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "parameters", "hyphens")
STATISTICS = tuple(f"{key}_{kind}" for key in ("suffix", "site", "section") for kind in ("urls", "length", "digits"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits the host or one above it and starts the path; else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def lexical_features(df: DataFrame) -> DataFrame:
    """Add the lexical features and the keys of the suffix statistics to (url, host, path)."""
    url = F.coalesce("url", F.lit(""))
    n = F.length(url)
    letters = F.array_distinct(F.split(url, ""))
    share = lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(F.filter(letters, lambda c: c != ""), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    names = F.split("host", r"\.")
    return df.withColumns({
        "length": n, "digits": F.regexp_count(url, F.lit("[0-9]")), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": F.regexp_count("path", F.lit(r"/[^/]")), "labels": F.size(names),
        "digit_ratio": F.when(n > 0, F.regexp_count(url, F.lit("[0-9]")) / n).otherwise(0.0),
        "entropy": F.when(n > 0, entropy).otherwise(0.0),
        "parameters": F.regexp_count(query, F.lit(r"[^&]+")), "hyphens": F.regexp_count("host", F.lit("-")),
        "suffix": F.substring_index("host", ".", -1), "site": F.substring_index("host", ".", -2),
        "section": F.concat(F.substring_index("host", ".", -2), F.regexp_extract("path", r"^(/[^/]*/)", 1))})


def suffix_statistics(urls: DataFrame, key: str) -> DataFrame:
    """(key, urls, length, digits): log count of all URLs, their mean length and their share of digits. No label goes into them: a
    URL that a rule fits would only tell its own verdict."""
    n, length, digits = F.count("*"), F.sum("length"), F.sum("digits")
    return urls.groupBy(key).agg(F.log1p(n.cast("double")).alias(f"{key}_urls"), (length / n).alias(f"{key}_length"),
                                 F.when(length > 0, digits / length).otherwise(0.0).alias(f"{key}_digits"))


def with_statistics(urls: DataFrame) -> DataFrame:
    """Add the statistics of the last label, the last two, and these with the first folder. They are
    gathered from all URLs; keys are joined after counting, rows of a frequent key staying spread."""
    for key in ("suffix", "site", "section"):
        urls = urls.join(suffix_statistics(urls, key), key, "left")
    return urls


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules: Sequence[tuple[str, str]] = RULES, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, block_score (of the trees).

    URLs that fit a rule are the labelled ones. The trees learn from at most ``training_rows`` of them, by the look of the URL and label-free
    statistics of its suffixes over all URLs, and judge the URLs that fit none. A null URL, or one without ``://``, has
    an empty host and path, and so no rule. With labels of one kind only, that kind is the verdict; with
    none, everything is allowed. Repeated rows get equal results; an empty table gives no rows.
    """
    split = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    split = split.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    split = split.withColumn("label", F.when(F.col("found.verdict") == "block", 1.0).when(F.col("found").isNotNull(), 0.0))
    rows = materialize(with_statistics(materialize(lexical_features(split), "urls")), "url-features")
    scored = score(rows, rows.where("label IS NOT NULL"), training_rows)
    guess = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_col), "host", "path", F.col("found.rule").alias("rule"),
                         F.coalesce("found.verdict", guess).alias("verdict"), F.col("score").alias("block_score"))


def score(rows: DataFrame, labelled: DataFrame, training_rows: int) -> DataFrame:
    """Add ``score``, the chance of being blocked, learned from the labelled rows."""
    kinds = [r["label"] for r in labelled.select("label").distinct().collect()]
    if len(kinds) < 2:
        return rows.withColumn("score", F.lit(kinds[0] if kinds else 0.0))
    features = VectorAssembler(inputCols=[*LEXICAL, *STATISTICS], outputCol="features")
    chosen = labelled.select("label", *LEXICAL, *STATISTICS, F.xxhash64("url").alias("_draw"))
    # one partition in a fixed order, so that reruns grow the same trees; bounded by training_rows
    sample = chosen.orderBy("_draw").limit(training_rows).coalesce(1).sortWithinPartitions("_draw", "length", "label")
    model = GBTClassifier(featuresCol="features", labelCol="label", maxIter=10, maxDepth=4, seed=7).fit(
        features.transform(sample))
    judged = model.setProbabilityCol("_p").transform(features.transform(rows))
    return judged.withColumn("score", vector_to_array("_p")[1])
