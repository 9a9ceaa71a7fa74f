"""Run registered queries next to their SQL and compare whole results.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def ordered(rows):
    def key(row):
        return tuple((v is None, "" if v is None else v) if not isinstance(v, float) else (math.isnan(v), v) for v in row)

    return sorted(rows, key=lambda row: tuple(map(str, key(row))))


def differences(spark, con, folder: str, name: str) -> list[str]:
    df = queries()[name](spark, folder)
    names = sorted(df.columns)
    mine = [tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    found = con.sql(oracle_sql()[name])
    theirs_names = sorted(found.columns)
    if theirs_names != names:
        return [f"columns {names} against {theirs_names}"]
    problems = []
    kinds = dict(zip(found.columns, map(str, found.types)))
    for field in df.schema:
        if KINDS.get(field.dataType.simpleString(), "?") != kinds[field.name]:
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} against {kinds[field.name]}")
    theirs = found.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall()
    if len(mine) != len(theirs):
        return [*problems, f"{len(mine)} rows against {len(theirs)}"]
    a, b = ordered(mine), ordered(theirs)
    if a != b:
        at = next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
        problems.append(f"{sum(x != y for x, y in zip(a, b))} rows differ, first {dict(zip(names, a[at]))} against {b[at]}")
    return problems


def main() -> int:
    from loadvane.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:] or list(queries())
    spark = build_session(
        master="local[8]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = database(folder), 0
    for name in chosen:
        began = time.time()
        try:
            if name in oracle_sql():
                problems = differences(spark, con, folder, name)
            else:
                problems = [] if queries()[name](spark, folder).collect() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(problems)
        mark = "ok " if not problems else "BAD"
        print(f"{mark} {name} {time.time() - began:.1f}s {'' if name in oracle_sql() else '(rows only)'} {problems or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
