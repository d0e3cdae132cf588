"""Run queries and their SQL side by side: python tools/check_queries.py [sf_dir] [key ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat() if hasattr(value, "tzinfo") else value.isoformat()
    return value


def _key(row):
    return tuple((v is None, str(type(v).__name__), str(v)) for v in row)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=_key)


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "float": "FLOAT",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "array<string>": "VARCHAR[]",
    "array<double>": "DOUBLE[]",
}


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    relation = con.sql(sql)
    if sorted(spark_df.columns) != sorted(relation.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(relation.columns)}"
    types = dict(zip(relation.columns, (str(t) for t in relation.types)))
    wrong = {c: (t, types[c]) for c, t in spark_df.dtypes if TYPES.get(t, t) != types[c]}
    left = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    right = rows_of(relation.columns, relation.fetchall())
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            names = sorted(spark_df.columns)
            return "values " + str([(n, x, y) for n, x, y in zip(names, a, b) if x != y][:4]) + f" in {a}"
    return f"types {wrong}" if wrong else None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    from ledgerlens.catalog import registry
    from ledgerlens.session import build_session

    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    spark = build_session("check", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for key, q in registry.load().items():
        if wanted and key not in wanted:
            continue
        start = time.time()
        try:
            if q.sql is None:
                note = f"rows only: {q.run(spark, sf_dir).count()}"
            else:
                note = compare(q.run(spark, sf_dir), con, q.sql)
        except Exception as error:  # report and go on with the others
            note = f"{type(error).__name__}: {str(error)[:700]}"
        ok = note is None or note.startswith("rows only")
        bad += not ok
        print(f"{'ok  ' if ok else 'BAD '} {key} {time.time() - start:.2f}s {note or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
