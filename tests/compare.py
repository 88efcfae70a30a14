"""Run a query on Spark and its checking SQL on DuckDB and compare the rows."""

import datetime
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_norm(record[i]) for i in order) for record in records]
    return sorted(rows, key=repr)


def diff(spark_df, con, sql):
    """None when equal, else a short description of the first difference."""
    names = spark_df.columns
    relation = con.execute(sql)
    oracle_names = [d[0] for d in relation.description]
    if sorted(names) != sorted(oracle_names):
        return f"columns {sorted(set(names) ^ set(oracle_names))}"
    types = dict(zip(oracle_names, [str(d[1]) for d in relation.description]))
    got = rows_of([tuple(r) for r in spark_df.collect()], names)
    want = rows_of(relation.fetchall(), oracle_names)
    if len(got) != len(want):
        return f"{len(got)} rows, want {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{sorted(names)}: got {a}, want {b}"
    wide = [n for n, t in types.items() if "HUGEINT" in t or "DECIMAL" in t]
    return f"wide types {wide}" if wide else None
