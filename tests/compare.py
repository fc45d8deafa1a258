"""Run registered queries against their SQL in DuckDB and compare the rows.

    python tests/compare.py [folder of tables] [query ...]
"""

import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return ("time", str(value))
    return (type(value).__name__, repr(value))


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(row[i]) for i in order) for row in rows], key=repr)


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def compare(spark, connection, folder, function, sql):
    """None if equal, else a short text; also the row count and the seconds."""
    start = time.time()
    df = function(spark, folder)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    if sql is None:
        return None, len(got), seconds
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    want = normal(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got), seconds
    if got == want:
        return None, len(got), seconds
    extra = [r for r in got if r not in set(want)][:2]
    lost = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} rows, wanted {len(want)}\n   got    {extra}\n   wanted {lost}", len(got), seconds


def main():
    import __spark_entry__ as entry
    from cratework.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    wrong = 0
    for name, function in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        try:
            problem, n, seconds = compare(spark, connection, folder, function, entry.oracle_sql().get(name))
        except Exception as error:  # report and go on
            problem, n, seconds = f"{type(error).__name__}: {str(error)[:1500]}", 0, 0.0
        wrong += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name:32s} {n:8d} rows {seconds:6.2f}s {problem or ''}", flush=True)
    print("wrong:", wrong)


if __name__ == "__main__":
    main()
