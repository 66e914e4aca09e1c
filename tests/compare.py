"""Run queries and their SQL counterparts side by side.

python tests/compare.py [sf] [query ...]
"""

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    rows = Counter(tuple(plain(r[n]) for n in names) for r in df.select(*names).collect())
    return names, rows


def sql_rows(con, sql):
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    return [columns[i] for i in order], rows


SAME_TYPE = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def type_mismatches(df, con, sql):
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {
        name: (kind, described.get(name))
        for name, kind in df.dtypes
        if SAME_TYPE.get(kind) != described.get(name)
    }


def difference(spark, con, sf_dir, query, sql):
    """None if equal, else a short description."""
    df = query(spark, sf_dir)
    types = type_mismatches(df, con, sql)
    if types:
        return f"types {types}"
    names, ours = spark_rows(df)
    sql_names, theirs = sql_rows(con, sql)
    if names != sql_names:
        return f"columns {names} / {sql_names}"
    if ours != theirs:
        return (
            f"rows {sum(ours.values())} / {sum(theirs.values())}; "
            f"only ours {list((ours - theirs))[:2]}; only theirs {list((theirs - ours))[:2]}"
        )
    return None if ours else "no rows"


def main():
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf, wanted = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), []
    for name, query in queries().items():
        if name not in sqls or wanted and name not in wanted:
            continue
        start = time.time()
        try:
            found = difference(spark, con, sf_dir, query, sqls[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:900]}"
        print(f"{name}: {found or 'ok'} ({time.time() - start:.1f} s)", flush=True)
        if found:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main()
