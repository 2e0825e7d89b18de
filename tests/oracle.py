"""Run named queries in Spark and their SQL twins in DuckDB and compare the rows.

As a script: ``python tests/oracle.py <folder> [name ...]``.
"""

import datetime
import decimal
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(frame):
    def unwrap(value):
        return value.asDict(recursive=True) if hasattr(value, "asDict") else value

    rows = [[unwrap(v) for v in row] for row in frame.collect()]
    return as_rows(frame.columns, rows)


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    return as_rows(names, cursor.fetchall())


def difference(frame, connection, sql):
    """``None`` when both give the same columns and rows, else what differs first."""
    names, rows = spark_rows(frame)
    other_names, other_rows = sql_rows(connection, sql)
    if names != other_names:
        return f"columns {names} / {other_names}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} / {len(other_rows)} rows"
    for ours, theirs in zip(rows, other_rows):
        if ours != theirs:
            return f"{names}: {ours} / {theirs}"
    return None


def main(folder, chosen):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from afterplay.session import local_session
    import __spark_entry__ as entry

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in chosen or queries:
        begin = time.time()
        try:
            frame = queries[name](spark, folder)
            if name in sqls:
                problem = difference(frame, connection, sqls[name])
                outcome = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                outcome = f"rows {len(frame.collect())}"
        except Exception as error:  # one bad query must not hide the others
            outcome = f"ERROR {str(error)[:600]}"
        failed += outcome.startswith(("DIFF", "ERR"))
        print(f"{name:28s} {time.time() - begin:6.2f}s {outcome}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
