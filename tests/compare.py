"""Compare a query with its SQL, ignoring row order and column order."""

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _value(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df, db, sql):
    """Empty when equal, else a description."""
    expected = db.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    want = _bag(names, expected.fetchall())
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        return ""
    return (f"{sum(got.values())} rows against {sum(want.values())}; "
            f"only ours {list((got - want).items())[:2]}; only theirs {list((want - got).items())[:2]}")
