"""Compare a Spark result with a DuckDB result: columns by name, rows in any order."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(value(r[i]) for i in order) for r in data), key=repr)


def of_spark(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def of_duckdb(con, sql):
    cur = con.execute(sql)
    return rows([d[0] for d in cur.description], cur.fetchall())
