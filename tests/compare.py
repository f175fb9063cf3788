"""Run a registered query and its SQL on the same parquet files and compare all rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def differences(spark, con, query, sql, sf_dir):
    """A short text describing the difference, or an empty string."""
    frame = query(spark, sf_dir)
    mine = frame.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    order = sorted(names)
    left = Counter(tuple(_plain(r[c]) for c in order) for r in mine)
    at = [names.index(c) for c in order]
    right = Counter(tuple(_plain(r[i]) for i in at) for r in theirs)
    if left != right:
        extra, missing = list((left - right).items())[:2], list((right - left).items())[:2]
        return f"{len(mine)} rows against {len(theirs)}; only spark {str(extra)[:400]}; only sql {str(missing)[:400]}"
    decimals = {n: str(t) for n, t in zip(names, [d[1] for d in cursor.description])}
    for name, kind in frame.dtypes:
        if kind.startswith("decimal") and decimals[name].upper().replace(" ", "") != kind.upper():
            return f"type of {name}: {kind} against {decimals[name]}"
    return "" if mine else "no rows"
