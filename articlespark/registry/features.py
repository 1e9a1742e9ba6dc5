"""Feature engineering and metrics on given prediction tables."""

from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import metrics, models
from ..operators.vectors import coordinates
from ..runtime import materialize
from .core import ARTICLES, STOP_SQL, STOPWORDS, articles, register, table, tokens_sql

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("ml_scale", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem), 6) AS {c}" for c in _NUM) + " FROM lineitem")
def ml_scale(spark, d):
    items = table(spark, d, "lineitem")
    moments = ft.fit_scale(items, _NUM)
    return items.select("l_orderkey", "l_linenumber", *[F.round(ft.standardize(F.col(c), *moments[c]), 6).alias(c) for c in _NUM])


_YJ = {0.5: "(power(x + 1, 0.5) - 1) / 0.5", 0.0: "ln(1 + x)"}
_YJ_NEG = {0.5: "-(power(1 - x, 1.5) - 1) / 1.5", 0.0: "-(power(1 - x, 2.0) - 1) / 2.0"}


@register("ml_yeojohnson", """WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity - 20 AS x FROM lineitem)
SELECT l_orderkey, l_linenumber, """ + ", ".join(
    f"round(CASE WHEN x >= 0 THEN {_YJ[k].replace('x', 'greatest(x, 0)')} ELSE {_YJ_NEG[k].replace('x', 'least(x, 0)')} END, 6) AS {n}"
    for k, n in ((0.5, "half"), (0.0, "zero"))) + " FROM b")
def ml_yeojohnson(spark, d):
    x = F.col("l_quantity") - 20
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(ft.yeo_johnson(x, 0.5), 6).alias("half"),
                                              F.round(ft.yeo_johnson(x, 0.0), 6).alias("zero"))


@register("ml_yeojohnson_fit")
def ml_yeojohnson_fit(spark, d):
    items = table(spark, d, "lineitem")
    lambdas = {c: ft.fit_yeo_johnson(items, c) for c in ("l_quantity", "l_discount")}
    moved = items.select("l_orderkey", "l_linenumber", *[ft.yeo_johnson(F.col(c), lam).alias(c) for c, lam in lambdas.items()])
    moments = ft.fit_scale(moved, list(lambdas))
    return moved.select("l_orderkey", "l_linenumber", *[ft.standardize(F.col(c), *moments[c]).alias(c) for c in lambdas])


@register("ml_ordinal", """WITH codes AS (SELECT p_name, dense_rank() OVER (ORDER BY p_name) - 1 AS k FROM (SELECT DISTINCT p_name FROM part))
SELECT p_partkey, key, CAST(coalesce(k, -1) AS DOUBLE) AS code FROM (
  SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN 'no such part' ELSE p_name END AS key FROM part) LEFT JOIN codes ON p_name = key""")
def ml_ordinal(spark, d):
    """Codes of all names; every tenth row asks for a name they do not have."""
    part = table(spark, d, "part")
    codes = ft.ordinal_codes(part, "p_name")
    keyed = part.select("p_partkey", F.when(F.col("p_partkey") % 10 == 0, "no such part").otherwise(F.col("p_name")).alias("key"))
    return ft.encode_ordinal(keyed, "key", codes, "code")


@register("ml_onehot", """SELECT l_orderkey, l_linenumber, 'item_' || l_partkey || '/' || l_suppkey AS feature, 1.0::DOUBLE AS value FROM lineitem
WHERE l_linenumber <> 7 UNION ALL SELECT l_orderkey, l_linenumber, 'l_returnflag_' || l_returnflag, 1.0 FROM lineitem""")
def ml_onehot(spark, d):
    """A vector over all pairs of part and supplier and a short column; every seventh line asks for a pair there is none of."""
    pair = F.concat_ws("/", "l_partkey", "l_suppkey")
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", pair.alias("item"))
    model = ft.fit_features(items, onehot=["item", "l_returnflag"])
    asked = items.withColumn("item", F.when(F.col("l_linenumber") == 7, "none").otherwise(F.col("item")))
    rows = coordinates(model.transform(asked, ["l_orderkey", "l_linenumber"]), "features", ["l_orderkey", "l_linenumber"])
    return rows.join(model.names(spark), "index").select("l_orderkey", "l_linenumber", "feature", "value")


_TARGET = "CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END"


def _target(spark, d):
    return table(spark, d, "lineitem").withColumn("label", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))


@register("ml_corr_target", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, {_TARGET}), 6) AS correlation FROM lineitem" for c in _NUM))
def ml_corr_target(spark, d):
    return ft.target_correlation(_target(spark, d), _NUM).withColumn("correlation", F.round("correlation", 6))


@register("ml_var_filter", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(var_pop({c}), 6) AS variance, var_pop({c}) > 0.01 AS kept FROM lineitem" for c in _NUM))
def ml_var_filter(spark, d):
    return ft.variance_filter(table(spark, d, "lineitem"), _NUM).withColumn("variance", F.round("variance", 6))


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "net"]


@register("ml_corr_filter", "WITH b AS (SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem), c AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS earlier, '{b}' AS feature, abs(corr({a}, {b})) AS correlation FROM b"
    for j, b in enumerate(_CORR) for a in _CORR[:j])
    + ") SELECT earlier, feature, round(correlation, 6) AS correlation, feature IN (SELECT feature FROM c WHERE correlation > 0.9) AS dropped FROM c")
def ml_corr_filter(spark, d):
    items = table(spark, d, "lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    pairs = materialize(ft.pair_correlations(items, _CORR), "pairs")
    # a row per feature at most
    dropped = ft.too_close(pairs).withColumn("dropped", F.lit(True))
    return (pairs.join(F.broadcast(dropped), "feature", "left")
            .select("earlier", "feature", F.round("correlation", 6).alias("correlation"), F.coalesce("dropped", F.lit(False)).alias("dropped")))


_FEATURES = f"""WITH b AS (SELECT l_orderkey, l_linenumber, {_TARGET} AS label, l_returnflag, l_linestatus, l_partkey || '/' || l_suppkey AS item,
  l_quantity, l_discount FROM lineitem),
m AS (SELECT avg(l_quantity) AS a, stddev_pop(l_quantity) AS s, avg(l_discount) AS da, stddev_pop(l_discount) AS ds FROM lineitem),
k AS (SELECT l_linestatus, dense_rank() OVER (ORDER BY l_linestatus) - 1 AS code FROM (SELECT DISTINCT l_linestatus FROM lineitem)),
f AS (SELECT l_orderkey, l_linenumber, label, 'item_' || item AS feature, 1.0::DOUBLE AS value FROM b
  UNION ALL SELECT l_orderkey, l_linenumber, label, 'l_returnflag_' || l_returnflag, 1.0 FROM b
  UNION ALL SELECT l_orderkey, l_linenumber, label, 'l_quantity', round((l_quantity - a) / s, 6) FROM b, m
  UNION ALL SELECT l_orderkey, l_linenumber, label, 'l_discount', round((l_discount - da) / ds, 6) FROM b, m
  UNION ALL SELECT l_orderkey, l_linenumber, label, 'l_linestatus', code::DOUBLE FROM b JOIN k USING (l_linestatus))"""


@register("ml_features", _FEATURES + " SELECT * FROM f WHERE value <> 0")
def ml_features(spark, d):
    """Routed columns, one of them with a value for nearly every row, as one sparse vector."""
    keep = ["l_orderkey", "l_linenumber", "label"]
    items = _target(spark, d).select(*keep, F.concat_ws("/", "l_partkey", "l_suppkey").alias("item"), "l_returnflag", "l_quantity", "l_discount", "l_linestatus")
    routed = ft.route_columns(items, keep, high_cardinality=["l_linestatus"])
    model = ft.fit_features(items, routed["onehot"], routed["skewed"], routed["numeric"], routed["ordinal"])
    rows = coordinates(model.transform(items, keep), "features", keep).join(model.names(spark), "index")
    return rows.select(*keep, "feature", F.round("value", 6).alias("value")).where("value <> 0")


_DIMENSIONS = 64


@register("ml_corr_wide", f"""WITH v AS (SELECT row_number() OVER () AS r, embedding FROM embeddings WHERE len(embedding) = {_DIMENSIONS}),
x AS (SELECT r, unnest(embedding)::DOUBLE AS x, unnest(range({_DIMENSIONS})) AS i FROM v)
SELECT 'e' || a.i AS earlier, 'e' || b.i AS feature, round(abs(corr(a.x, b.x)), 6) AS correlation FROM x a JOIN x b ON a.r = b.r AND a.i < b.i GROUP BY a.i, b.i""")
def ml_corr_wide(spark, d):
    """All pairs of the coordinates of the embeddings."""
    rows = table(spark, d, "embeddings").where(F.size("embedding") == _DIMENSIONS)
    wide = rows.select(*[F.get("embedding", F.lit(i)).alias(f"e{i}") for i in range(_DIMENSIONS)])
    return ft.pair_correlations(wide, wide.columns).withColumn("correlation", F.round("correlation", 6))


# Predictions: the label, flipped for every seventh document; half the rows are the test split
PREDICTIONS = """predictions AS (SELECT doc_id AS article_id, CASE WHEN doc_id % 2 = 0 THEN 'test' ELSE 'train' END AS split, quality AS label,
  CAST(CASE WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END AS DOUBLE) AS prediction FROM labels)"""


def predictions(spark, d):
    k, q = F.col("doc_id"), F.col("quality")
    return table(spark, d, "labels").select(
        k.alias("article_id"), F.when(k % 2 == 0, "test").otherwise("train").alias("split"), q.alias("label"),
        F.when(k % 7 == 0, 1 - q).otherwise(q).cast("double").alias("prediction"))


CELLS = """CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS true_negatives, CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS false_positives,
CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS false_negatives, CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS true_positives"""


@register("ml_confusion", f"WITH {PREDICTIONS} SELECT {CELLS} FROM predictions")
def ml_confusion(spark, d):
    return metrics.confusion(predictions(spark, d))


def _report_sql(by: str) -> str:
    g = f"{by}, " if by else ""
    return f"""WITH {PREDICTIONS}, c AS (SELECT {g}{CELLS} FROM predictions {'GROUP BY ' + by if by else ''}),
k AS (SELECT {g}0 AS class, true_negatives AS hit, false_negatives AS wrong, false_positives AS missed FROM c
      UNION ALL SELECT {g}1, true_positives, false_positives, false_negatives FROM c),
p AS (SELECT {g}class, hit, hit / (hit + wrong) AS precision, hit / (hit + missed) AS recall, hit + missed AS support FROM k),
f AS (SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM p)
SELECT {g}CAST(class AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1_score, support FROM f
UNION ALL SELECT {g}'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f {'GROUP BY ' + by if by else ''}
UNION ALL SELECT {g}'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f {'GROUP BY ' + by if by else ''}
UNION ALL SELECT {g}'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM f {'GROUP BY ' + by if by else ''}"""


def _rounded(report):
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1_score")})


@register("ml_report", _report_sql(""))
def ml_report(spark, d):
    return _rounded(metrics.report(predictions(spark, d)))


@register("ml_train_test_eval", _report_sql("split"))
def ml_train_test_eval(spark, d):
    return _rounded(metrics.report(predictions(spark, d), ["split"]))


@register("ml_mse", f"""WITH {PREDICTIONS} SELECT split, round(avg((prediction * 4 + 1 - (label * 4 + 1)) ** 2), 6) AS mean_squared_error
FROM predictions GROUP BY split""")
def ml_mse(spark, d):
    scored = predictions(spark, d).withColumns({"label": F.col("label") * 4 + 1, "prediction": F.col("prediction") * 4 + 1})
    return metrics.mean_squared_error(scored, ["split"]).withColumn("mean_squared_error", F.round("mean_squared_error", 6))


@register("ml_tfidf", f"""WITH {ARTICLES}, w AS (SELECT article_id, unnest({tokens_sql('article_text')}) AS term FROM articles),
c AS (SELECT term, CAST(count(*) AS BIGINT) AS tf, CAST(count(DISTINCT article_id) AS BIGINT) AS df FROM w WHERE term NOT IN {STOP_SQL} GROUP BY term)
SELECT term, tf, df, round(ln((1 + (SELECT count(*) FROM articles)) / (1 + df)) + 1, 6) AS idf FROM c ORDER BY tf DESC, term LIMIT 1000""")
def ml_tfidf(spark, d):
    return models.top_terms(articles(spark, d), "article_text", 1000, STOPWORDS).withColumn("idf", F.round("idf", 6))
