"""Runs a query and its SQL side by side and compares rows by value, columns by name."""

import datetime
import decimal
import math

import duckdb

from skein.plans.tables import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6) + 0.0
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    return x


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(v[i]) for i in order) for v in values), key=repr)


def compare(spark, con, sf_dir, query, sql):
    made = query(spark, sf_dir)
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    assert sorted(made.columns) == sorted(names), (sorted(made.columns), sorted(names))
    got, want = rows(made.columns, [tuple(r) for r in made.collect()]), rows(names, rel.fetchall())
    assert len(got) == len(want), (len(got), len(want), got[:2], want[:2])
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    assert not bad, (len(bad), bad[:3])
    kinds = [type(x) for x in got[0]] if got else []
    assert kinds == ([type(x) for x in want[0]] if want else []) or any(x is None for x in got[0]), (got[0], want[0])
    return len(got)
