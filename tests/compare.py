"""Run a query on Spark and its SQL on DuckDB and compare the rows, whatever their order."""

import math
import os

import duckdb

TESTDATA = os.environ.get("SPEECHLAKE_TESTDATA", "/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def sql_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    result = con.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        if hasattr(v, "to_eng_string"):
            return repr(float(v))
        return repr(v)

    return [columns[i] for i in order], sorted([value(row[i]) for i in order] for row in rows)


def difference(query, sql, spark, sf_dir):
    """None if the rows agree, else a short account."""
    frame = query(spark, sf_dir)
    got_columns, got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    want_columns, want = canonical(*sql_rows(sf_dir, sql))
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        first = next(((g, w) for g, w in zip(got, want) if g != w), None)
        return f"{len(got)} rows, SQL {len(want)}; first difference {str(first)[:600]}"
    return None
