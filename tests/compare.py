"""Spark rows against DuckDB rows, whatever their order."""

import math
import os
import sys

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in found), key=repr)


def differences(spark, sf_dir, name, fn, sql):
    """Nothing, or what differs."""
    df = fn(spark, sf_dir)
    got = rows(df.columns, df.collect())
    cur = connection(sf_dir).execute(sql)
    names = [c[0] for c in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"{name}: columns {sorted(set(names) ^ set(df.columns))}"
    if got != want:
        only = [x for x in got if x not in want][:2], [x for x in want if x not in got][:2]
        return f"{name}: {len(got)} and {len(want)} rows; {sorted(names)}; only Spark {only[0]}; only DuckDB {only[1]}"
    kinds = {c[0]: str(c[1]) for c in cur.description}
    return "" if len(got) else f"{name}: empty {kinds}"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    os.environ["PYTHONPATH"] = sys.path[0]
    import time

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[3]").config("spark.sql.shuffle.partitions", "3").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from brindle import catalog

    for name, fn in catalog.QUERIES.items():
        if len(sys.argv) > 2 and not any(x in name for x in sys.argv[2:]):
            continue
        t = time.time()
        try:
            said = differences(spark, sys.argv[1], name, fn, catalog.ORACLE_SQL[name]) if name in catalog.ORACLE_SQL else f"{name}: {fn(spark, sys.argv[1]).count()} rows, no SQL"
        except Exception as e:
            said = f"{name}: {type(e).__name__} {str(e)[:700]}"
        print(f"{time.time() - t:.1f}", said or f"{name} ok", flush=True)
