"""Compare a Spark result with DuckDB on the same Parquet tables."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
KINDS = {"TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int", "HUGEINT": "int",
         "int": "int", "bigint": "int", "DOUBLE": "double", "double": "double", "VARCHAR": "string",
         "string": "string", "BOOLEAN": "boolean", "boolean": "boolean", "DATE": "date", "date": "date"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.date() if value.time() == datetime.time() else value
    return value


def _sorted(rows, order):
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: [(v is not None, str(type(v)), v if v is not None else 0) for v in r])


def differences(frame, con, sql: str) -> list[str]:
    """What differs between the two results; an empty list means equal."""
    relation = con.sql(sql)
    ours, theirs = frame.columns, relation.columns
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(ours)} against {sorted(theirs)}"]
    found = []
    kinds = {f.name: KINDS.get(f.dataType.simpleString(), "?") for f in frame.schema.fields}
    for name, kind in zip(theirs, relation.types):
        if kinds[name] != KINDS.get(str(kind), "??"):
            found.append(f"type of {name}: {kinds[name]} against {kind}")
    a = _sorted([tuple(r) for r in frame.collect()], [ours.index(c) for c in sorted(ours)])
    b = _sorted(relation.fetchall(), [list(theirs).index(c) for c in sorted(theirs)])
    if len(a) != len(b):
        found.append(f"{len(a)} rows against {len(b)}")
    wrong = [(p, q) for p, q in zip(a, b) if p != q]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found
