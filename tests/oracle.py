"""Runs a query and its SQL over the same tables and compares the rows."""

from pathlib import Path

import duckdb


def _plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def compare(spark, name: str, query, sql: str, folder: str) -> int:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    rel = con.sql(sql)
    df = query(spark, folder)
    assert sorted(df.columns) == sorted(rel.columns), (name, df.columns, rel.columns)
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    at = [rel.columns.index(c) for c in columns]
    want = sorted((tuple(_plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert len(got) == len(want), (name, len(got), len(want), [x for x in got if x not in set(want)][:3], [x for x in want if x not in set(got)][:3])
    for g, w in zip(got, want):
        assert g == w, (name, columns, g, w)
    return len(got)
