"""Order-free comparison of a DataFrame with its SQL counterpart in DuckDB."""

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return f"dec:{v}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    return repr(v)


def result(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    """None when equal, else a short description of the difference."""
    ran = con.execute(sql)
    want_cols, want = result([d[0] for d in ran.description], ran.fetchall())
    got_cols, got = result(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got == want:
        return None
    only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return (
        f"{len(got)} rows against {len(want)}; columns {got_cols}; "
        f"only here {len(only_got)}: {only_got[:3]}; only in SQL {len(only_want)}: {only_want[:3]}"
    )
