"""Run every registered query and compare it with its SQL: ``python tools/check_queries.py FOLDER [name…]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from partledger.plans.catalog import BUILDERS, ORACLES
from partledger.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(spark_df, con, sql: str) -> str:
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = rows_of(names, cursor.fetchall())
    if sorted(c.lower() for c in names) != sorted(c.lower() for c in spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(got) != len(wanted):
        return f"rows {len(got)} != {len(wanted)}"
    wrong = [(g, x) for g, x in zip(got, wanted) if not all(same(p, q) for p, q in zip(g, x))]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else ""


def main() -> None:
    folder, names = sys.argv[1], sys.argv[2:] or list(BUILDERS)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = BUILDERS[name](spark, folder)
            if name in ORACLES:
                note = compare(df, con, ORACLES[name])
                state = f"DIFF {note[:600]}" if note else "ok"
            else:
                state = f"rows {df.count()}"
        except Exception as error:
            state = f"ERROR {type(error).__name__} {str(error)[:400]}"
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{name:28s} {time.time() - start:6.1f}s  {state}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
