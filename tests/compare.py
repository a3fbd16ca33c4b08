"""Run registered queries next to their SQL and compare schema, row count and values."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_INT = {"TINYINT", "SMALLINT", "INTEGER", "BIGINT"}
_SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 9)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = _bag(names, result.fetchall())
    found = []
    if sorted(names) != sorted(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} expected {sorted(names)}")
        return found
    for field in spark_df.schema.fields:
        kind = field.dataType.simpleString()
        if _SPARK_TO_SQL.get(kind, kind) != types[field.name]:
            found.append(f"type of {field.name}: {kind} expected {types[field.name]}")
    actual = _bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows expected {len(expected)}")
    if actual != expected:
        pairs = [(a, e) for a, e in zip(actual, expected) if a != e]
        found.append(f"values differ in {len(pairs)} rows, first {pairs[:2]}"[:600])
    return found


def main(names: list[str]) -> int:
    from tests.conftest import session

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    spark, con, bad = session(), connect(), 0
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, SF_DIR)
            if name in oracles:
                found = differences(df, con, oracles[name])
                note = f"rows={df.count()}" if not found else "; ".join(found)
            else:
                found, note = [], f"rows={df.count()} (no SQL)"
        except Exception as error:  # noqa: BLE001
            found, note = ["error"], f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
