"""Every registered query with SQL agrees with it on the smallest data."""

import oracle
import pytest

import __spark_entry__ as entry_point

SQL = entry_point.oracle_sql()
QUERIES = entry_point.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_agrees_with_sql(spark, con, sf_dir, key):
    message = oracle.compare(spark, con, key, QUERIES[key], SQL[key], sf_dir)
    assert message in ("", "SQL gives no rows")


def test_entry_gives_rows(spark):
    assert entry_point.entry(spark).count() > 0


# The searches and eliminations fit many models; tests/oracle.py runs them too.
SLOW = {"ml_grid_cv", "ml_rfe", "ml_linear", "ml_rf_class", "ml_rf_reg", "ml_score", "article_table", "article_dashboard"}


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_query_gives_rows(spark, sf_dir, key):
    assert QUERIES[key](spark, sf_dir).count() > 0


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


def test_dashboard_counts_every_labelled_line_item_once(spark, sf_dir):
    counted = QUERIES["agg_dashboard"](spark, sf_dir).agg({"article_id": "sum"}).first()[0]
    assert counted == spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_returnflag IN ('R', 'A')").count()
