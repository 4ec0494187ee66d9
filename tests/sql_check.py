"""Holds a query's rows against its SQL's in DuckDB."""

import glob
import os
from collections import Counter

import duckdb


def engine(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def rows_of_sql(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(r[i] for i in order) for r in cursor.fetchall())


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, Counter(tuple(r) for r in df.select(*names).collect())


def assert_same(con, df, sql):
    sql_names, expected = rows_of_sql(con, sql)
    names, found = rows_of_spark(df)
    assert names == sql_names
    assert found == expected
