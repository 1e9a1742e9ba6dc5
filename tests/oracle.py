"""Compare registered queries with their SQL; also runs as a script: python tests/oracle.py SF_DIR [KEY ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v) if v % 1 else int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.6f}".replace("-0.000000", "0.000000")
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return repr(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def kinds(columns, rows):
    """Python type name per column, from the values."""
    out = {}
    for i, c in enumerate(columns):
        out[c] = {type(r[i]).__name__ for r in rows if r[i] is not None}
    return out


def compare(spark, con, key, query, sql, sf_dir):
    """Empty string if query and SQL agree, else what differs."""
    df = query(spark, sf_dir)
    got_cols, got_rows = df.columns, [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if got_rows else "no rows"
    cur = con.execute(sql)
    want_cols, want_rows = [c[0] for c in cur.description], cur.fetchall()
    a, b = canonical(got_cols, got_rows), canonical(want_cols, want_rows)
    if a[0] != b[0]:
        return f"columns {a[0]} != {b[0]}"
    if not a[1] and not b[1]:
        return "SQL gives no rows"
    if a[1] != b[1]:
        left, right = set(a[1]) - set(b[1]), set(b[1]) - set(a[1])
        return (f"{len(a[1])} rows != {len(b[1])} rows; only Spark {len(left)}: {sorted(left)[:3]}; "
                f"only SQL {len(right)}: {sorted(right)[:3]}")
    k1, k2 = kinds(got_cols, got_rows), kinds(want_cols, want_rows)
    return f"types {k1} != {k2}" if k1 != k2 else ""


def session():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").appName("articlespark-tests")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    import __spark_entry__ as e
    sf_dir, keys = sys.argv[1], sys.argv[2:]
    spark, con = session(), connect(sf_dir)
    sqls, bad = e.oracle_sql(), 0
    for key, query in e.queries().items():
        if keys and key not in keys:
            continue
        start = time.time()
        try:
            message = compare(spark, con, key, query, sqls.get(key), sf_dir)
        except Exception as error:  # report and go on with the next query
            message = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(message)
        print(f"{'BAD' if message else 'ok '} {key} {time.time() - start:.1f}s {message}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
