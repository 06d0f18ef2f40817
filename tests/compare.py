"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def expected_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def differences(df, sql: str, sf_dir: str) -> list[str]:
    """Empty if the DataFrame and the SQL give the same bag of rows."""
    columns, rows = expected_rows(sql, sf_dir)
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(set(columns) ^ set(df.columns))}"]
    want, got = bag(columns, rows), bag(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        return []
    missing, surplus = list((want - got).items())[:2], list((got - want).items())[:2]
    return [f"rows {sum(want.values())} vs {sum(got.values())}", f"missing {missing}", f"surplus {surplus}"]
