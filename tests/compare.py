"""Run queries in Spark and DuckDB and compare their rows as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


_FAMILIES = {
    "byte": "integer", "short": "integer", "integer": "integer", "long": "integer",
    "TINYINT": "integer", "SMALLINT": "integer", "INTEGER": "integer", "BIGINT": "integer",
    "float": "float", "double": "double", "FLOAT": "float", "DOUBLE": "double",
    "string": "string", "VARCHAR": "string", "boolean": "boolean", "BOOLEAN": "boolean",
}


def differences(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark frame and the result of a SQL text; empty if nothing does."""
    result = connection.sql(sql)
    names = sorted(frame.columns)
    if names != sorted(result.columns):
        return [f"columns {names} / {sorted(result.columns)}"]
    spark_types = {f.name: _FAMILIES.get(f.dataType.typeName()) for f in frame.schema}
    sql_types = {n: _FAMILIES.get(str(t)) for n, t in zip(result.columns, result.types)}
    if spark_types != sql_types:
        return [f"types {spark_types} / {sql_types}"]
    table = frame.select(*names).toArrow()
    ours = Counter(zip(*(table.column(n).to_pylist() for n in names)))
    theirs_table = result.to_arrow_table()
    theirs = Counter(zip(*(theirs_table.column(n).to_pylist() for n in names)))
    found = []
    if ours.total() != theirs.total():
        found.append(f"rows {ours.total()} / {theirs.total()}")
    missing, extra = theirs - ours, ours - theirs
    if missing or extra:
        found.append(f"missing {missing.total()} {list(missing)[:2]} extra {list(extra)[:2]}"[:900])
    return found
