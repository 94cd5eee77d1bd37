"""Comparing a frame with SQL rows: columns by name, rows in any order."""

import math


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted(repr([plain(r[n]) for n in names]) for r in df.collect())


def rows_of_sql(con, sql):
    cur = con.execute(sql)
    found = [d[0] for d in cur.description]
    names = sorted(found)
    return names, sorted(repr([plain(dict(zip(found, r, strict=True))[n]) for n in names]) for r in cur.fetchall())
