"""Side-by-side comparison of the Spark queries with their SQL on the same Parquet files."""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

import duckdb

SF_ROOT = "/root/testdata"
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return ("f", value + 0.0)
    return ("x", "" if value is None else str(value)) if not isinstance(value, datetime.datetime) else ("t", str(value))


def _rows(rows, order):
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, connection, sql: str) -> str:
    """An empty string if schema and rows agree, else what differs."""
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    kinds = [str(d[1]) for d in relation.description]
    expected = relation.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    spark_kinds = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    duck_kinds = dict(zip(names, kinds))
    wrong = {n: (spark_kinds[n], duck_kinds[n]) for n in names if spark_kinds[n] != duck_kinds[n]}
    got = df.collect()
    shared = sorted(names)
    left = _rows(got, [df.columns.index(n) for n in shared])
    right = _rows(expected, [names.index(n) for n in shared])
    if len(left) != len(right):
        return f"{len(left)} vs {len(right)} rows"
    if left != right:
        first = next((a, b) for a, b in zip(left, right) if a != b)
        return f"rows differ, e.g. {dict(zip(shared, first[0]))} vs {dict(zip(shared, first[1]))}"
    if wrong:
        return f"types differ: {wrong}"
    return "" if left else "EMPTY RESULT"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from galecast.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = set(sys.argv[2:])
    sf_dir = f"{SF_ROOT}/sf{sf}"
    spark = local_session("oracle-check", 8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    oracle = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            outcome = compare(query(spark, sf_dir), connection, oracle[name])
        except Exception as error:  # report every query, whatever happens to one
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not outcome else 'FAIL'} {name} {time.time() - began:.2f}s {outcome}", flush=True)


if __name__ == "__main__":
    main()
