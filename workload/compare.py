"""Compare each query with its SQL: same columns, same types, same rows."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark type name -> names DuckDB may give the same values
SAME_TYPE = {
    "string": {"VARCHAR"},
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "date": {"DATE"},
    "boolean": {"BOOLEAN"},
}


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row: tuple):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def _plain(v):
    return 0.0 if isinstance(v, float) and v == 0 else v


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[list[str], int, float]:
    """Differences found (none if equal), row count, seconds of the Spark side."""
    began = time.time()
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(map(_plain, r)) for r in df.select(*columns).collect()]
    seconds = time.time() - began
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(types) != columns:
        return [f"columns {columns} against {sorted(types)}"], len(got), seconds
    for name, kind in df.dtypes:
        if types[name] not in SAME_TYPE[kind]:
            problems.append(f"{name}: {kind} against {types[name]}")
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
    want = [tuple(map(_plain, r)) for r in want]
    if len(got) != len(want):
        problems.append(f"{len(got)} rows against {len(want)}")
    for a, b in zip(sorted(got, key=_key), sorted(want, key=_key)):
        same = all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-12)) for x, y in zip(a, b))
        if not same:
            problems.append(f"{a} against {b}")
            break
    return problems, len(got), seconds
