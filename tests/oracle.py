"""Comparison of a registered query with its SQL, as the driver does it: rows, columns and values, in any order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def differences(spark, sf_dir: str, query, sql: str) -> str:
    """Empty if both sides agree, else what differs."""
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    want = con.sql(sql)
    names = sorted(want.columns)
    df = query(spark, sf_dir)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} and {names}"
    at = [want.columns.index(n) for n in names]
    theirs = Counter(tuple(plain(r[k]) for k in at) for r in want.fetchall())
    ours = Counter(tuple(plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    if ours == theirs:
        return ""
    return f"{sum(ours.values())} and {sum(theirs.values())} rows; {names}; only here {list((ours - theirs).items())[:2]}; only there {list((theirs - ours).items())[:2]}"
