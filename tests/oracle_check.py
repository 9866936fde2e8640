"""Run registered queries next to their SQL and compare the rows.

    python tests/oracle_check.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def sql_connection(folder: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, connection, folder, name, build, sql):
    """None when equal, else a description of the difference."""
    df = build(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if rows else "no rows"
    relation = connection.sql(sql)
    other = relation.fetchall()
    columns = relation.columns
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    kinds = dict(zip(columns, [KINDS.get(str(k), str(k)) for k in relation.types]))
    wrong = {c: (k, kinds[c]) for c, k in df.dtypes if kinds[c] != k}
    if wrong:
        return f"types {wrong}"
    mine, theirs = normal_rows(df.columns, rows), normal_rows(columns, other)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{str(a)[:300]} != {str(b)[:300]}"
    if not rows:
        return "no rows"
    return None


def local_session(threads: str = "8", memory: str = "8g"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{threads}]")
        .appName("opinarium")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", threads)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as contract

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(contract.queries())
    spark, connection = local_session(), sql_connection(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(
                spark, connection, folder, name, contract.queries()[name], contract.oracle_sql().get(name)
            )
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql" if name in contract.oracle_sql() else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind:4} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
        failed += problem is not None
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
