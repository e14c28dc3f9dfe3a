"""Runs a query and its SQL over the same tables and compares rows, names and types."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def types(con, relation: str) -> dict[str, str]:
    rows = con.execute(f"DESCRIBE {relation}").fetchall()
    return {r[0]: r[1].replace("TIMESTAMP WITH TIME ZONE", "TIMESTAMP") for r in rows}


def compare(con, df, sql: str) -> str | None:
    """None when equal, else what differs."""
    con.register("spark_arrow", df.toArrow())
    columns = types(con, "spark_arrow")
    raw = {r[0]: r[1] for r in con.execute("DESCRIBE spark_arrow").fetchall()}
    select = ", ".join(
        f'"{c}" AT TIME ZONE \'UTC\' AS "{c}"' if "TIME ZONE" in raw[c] else f'"{c}"' for c in sorted(columns)
    )
    con.execute(f"CREATE OR REPLACE TEMP TABLE ours AS SELECT {select} FROM spark_arrow")
    con.unregister("spark_arrow")
    con.execute(f"CREATE OR REPLACE TEMP TABLE wanted AS SELECT * FROM ({sql})")
    expected = types(con, "wanted")
    if columns != expected:
        return f"types differ: {set(columns.items()) ^ set(expected.items())}"
    names = ", ".join(f'"{c}"' for c in sorted(expected))
    extra = con.execute(f"SELECT * FROM ours EXCEPT ALL SELECT {names} FROM wanted LIMIT 3").fetchall()
    lost = con.execute(f"SELECT {names} FROM wanted EXCEPT ALL SELECT * FROM ours LIMIT 3").fetchall()
    if extra or lost:
        return f"columns {sorted(expected)}\n  only in ours: {extra}\n  only in SQL: {lost}"
    return None
