"""Compare registered queries with their SQL twins: `python tests/compare.py FOLDER [name ...]`."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


TIMES = {}


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark, con, query, sql, folder):
    """None when both give the same rows, else a short description."""
    TIMES["start"] = time.perf_counter()
    frame = query(spark, folder)
    rows = [tuple(r) for r in frame.collect()]
    TIMES["spark"] = time.perf_counter() - TIMES["start"]
    if sql is None:
        return None if rows else "no rows"
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    wanted = found.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {frame.columns} against {names}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows against {len(wanted)}"
    ours, theirs = sorted_rows(frame.columns, rows), sorted_rows(names, wanted)
    for mine, other in zip(ours, theirs):
        if mine != other or [type(x) for x in mine] != [type(x) for x in other]:
            return f"{str(mine)[:600]}\n   against {str(other)[:600]}"
    return None


def main(folder, wanted):
    from callsift import workload
    from callsift.session import local_session

    spark = local_session("callsift-compare")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name, query in workload.QUERIES.items():
        if wanted and name not in wanted:
            continue
        TIMES.update(start=time.perf_counter(), spark=0.0)
        try:
            problem = difference(spark, con, query, workload.SQL.get(name), folder)
        except Exception as error:  # a failing query is one line of the report
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        took = TIMES["spark"]
        note = "" if name in workload.SQL else " (no SQL)"
        print(f"{'ok ' if problem is None else 'BAD'} {name} {took:.2f}s{note}{'' if problem is None else ' ' + problem}", flush=True)
        bad += problem is not None
    print(f"{bad} differ")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
