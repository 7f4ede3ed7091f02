"""Order-insensitive comparison of a Spark result with a DuckDB oracle result."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    return str(v)


def _key(row):
    return tuple((x is None, "" if x is None else str(type(x)), x if x is not None else 0)
                 for x in row)


def rows_spark(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    data = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(data, key=_key)


def rows_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    names = rel.columns
    idx = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in idx]
    data = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    return cols, sorted(data, key=_key)


def diff(spark_df, con, sql: str, show: int = 5) -> str | None:
    sc, sr = rows_spark(spark_df)
    dc, dr = rows_duck(con, sql)
    if sc != dc:
        return f"columns differ:\n spark {sc}\n duck  {dc}"
    if len(sr) != len(dr):
        msg = f"row count spark={len(sr)} duck={len(dr)}"
    elif sr != dr:
        msg = "values differ"
    else:
        return None
    ss, ds = set(sr), set(dr)
    only_s = [r for r in sr if r not in ds][:show]
    only_d = [r for r in dr if r not in ss][:show]
    return f"{msg}\n cols {sc}\n only spark {only_s}\n only duck {only_d}"
