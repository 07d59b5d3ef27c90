"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb

from registry import inputs


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in inputs.GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(cells, key=repr)


def difference(spark, sf_dir, run, sql, connection) -> str | None:
    """None when columns, types' families and rows agree, else what differs."""
    result = run(spark, sf_dir)
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    if sorted(result.columns) != sorted(names):
        return f"columns {sorted(result.columns)} / {sorted(names)}"
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, kind in result.dtypes:
        if same.get(kind) != kinds[name]:
            return f"type of {name}: {kind} / {kinds[name]}"
    ours = _rows(result.columns, [tuple(r) for r in result.collect()])
    theirs = _rows(names, cursor.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"first difference {str(a)[:300]} / {str(b)[:300]}"
    return None if ours else "no rows"
