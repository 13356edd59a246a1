"""Compare registered queries with their SQL on DuckDB."""

import math
import os

import duckdb

from herald import fixtures as fx
from herald import registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def connect(sf_dir=SF_DIR):
    con = duckdb.connect()
    for t in fx.BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    return None if v is None else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows),
                  key=lambda r: tuple((v is None, v or "") for v in r))


def check(spark, con, name, sf_dir=SF_DIR):
    df = registry.QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    if name not in registry.ORACLES:
        assert got, name
        return len(got)
    result = con.execute(registry.ORACLES[name])
    columns = [c[0] for c in result.description]
    want = _rows(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns), (df.columns, columns)
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert not wrong, f"{len(wrong)} differ, first {wrong[:2]}"
    return len(got)
