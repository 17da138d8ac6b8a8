"""Compare a Spark result with DuckDB on the same Parquet files: names, kinds of types, exact rows."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or value != value:
        return "null"
    if isinstance(value, float):
        return f"float {value!r}"
    return f"{type(value).__name__} {value}"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both results agree, else a short account."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if actual == expected:
        return None
    only_a = sorted(set(actual) - set(expected))[:3]
    only_e = sorted(set(expected) - set(actual))[:3]
    return f"{len(actual)} rows against {len(expected)}; only here {only_a}; only in SQL {only_e}"
