"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(value: str) -> str:
    value = value.upper()
    for kinds, name in (
        (("BIGINT", "INT64", "LONG", "HUGEINT"), "bigint"), (("INTEGER", "INT"), "int"),
        (("DOUBLE",), "double"), (("VARCHAR", "STRING"), "string"), (("DECIMAL",), "decimal"),
        (("TIMESTAMP_NTZ", "TIMESTAMP"), "timestamp"), (("DATE",), "date"),
        (("BOOLEAN",), "boolean"),
    ):
        if value.startswith(kinds):
            return name
    return value


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(df, sql: str, con) -> list[str]:
    """Differences in columns, types, row count and values; empty when all agree."""
    names = sorted(df.columns)
    kinds = {f.name: _kind(f.dataType.simpleString()) for f in df.schema.fields}
    result = con.sql(sql)
    sql_kinds = {n: _kind(str(t)) for n, t in zip(result.columns, result.types)}
    if kinds != sql_kinds:
        return [f"schema: spark {kinds} sql {sql_kinds}"]
    got = _sorted([tuple(r[n] for n in names) for r in df.select(*[f"`{n}`" for n in names]).collect()])
    order = [result.columns.index(n) for n in names]
    want = _sorted([tuple(r[i] for i in order) for r in result.fetchall()])
    if len(got) != len(want):
        return [f"rows: spark {len(got)} sql {len(want)}"]
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return [f"{len(bad)} of {len(got)} rows differ, first {bad[0]}"] if bad else []
