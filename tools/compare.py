"""Run registered queries beside their SQL and report differences.

    python tools/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keystar.session import build_session  # noqa: E402
from workload import QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "SMALLINT": "smallint",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "FLOAT": "float",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def canonical(rows: list[tuple]) -> list[tuple]:
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str, inspect=None) -> tuple[bool, str, float]:
    q = QUERIES[name]
    start = time.time()
    df = q.run(spark, sf_dir)
    if inspect is not None:
        inspect(df)
    names = sorted(df.columns)
    mine = [tuple(r) for r in df.select(*names).collect()]
    took = time.time() - start
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if q.sql is None:
        return True, f"{len(mine)} rows, no SQL", took
    cursor = con.execute(q.sql)
    their_types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in cursor.description}
    order = [d[0] for d in cursor.description]
    theirs = [tuple(row[order.index(n)] for n in sorted(order)) for row in cursor.fetchall()]
    if types != their_types:
        diff = {k: (types.get(k), their_types.get(k)) for k in types.keys() | their_types.keys()
                if types.get(k) != their_types.get(k)}
        return False, f"schema differs {diff}", took
    a, b = canonical(mine), canonical(theirs)
    if a != b:
        only = [x for x in a if x not in set(b)][:3] if len(a) < 200000 else []
        other = [x for x in b if x not in set(a)][:3] if len(a) < 200000 else []
        return False, f"{len(a)} vs {len(b)} rows; mine {only} theirs {other}", took
    return True, f"{len(a)} rows", took


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    given = args.parse_args()
    spark = build_session(
        "compare",
        "local[8]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(given.sf)
    bad = []
    for name in given.names or QUERIES:
        try:
            ok, note, took = compare(spark, con, name, given.sf)
        except Exception as error:  # report and go on with the next query
            traceback.print_exc(limit=3)
            ok, note, took = False, f"{type(error).__name__}: {str(error)[:600]}", 0.0
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {took:6.2f}s {note}", flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(bad)} failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
