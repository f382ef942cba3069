"""Compare every query with its SQL text on one folder of tables.

    python -m workload.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal

import duckdb

from shelfline.session import local_session
from workload import load_all
from workload.registry import ENTRIES
from workload.star import Star

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def cell(value: object) -> str:
    if value is None:
        return "~"
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float):
        return repr(0.0 if value == 0 else value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(cell(v) for v in value) + "]"
    return str(value)


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def main(folder: str, wanted: list[str]) -> int:
    load_all()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    spark = local_session(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    star, failed = Star(spark, folder), []
    names = [n for n in ENTRIES if not wanted or any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in wanted)]
    for name in names:
        entry, start = ENTRIES[name], time.time()
        try:
            df = entry.run(star)
            got = rows_of(df.columns, df.collect())
            took = time.time() - start
            if entry.oracle is None:
                print(f"ROWS  {name} {len(got)} {took:.1f}s", flush=True)
                continue
            cur = con.execute(entry.oracle)
            cols = [d[0] for d in cur.description]
            want = rows_of(cols, cur.fetchall())
            if sorted(cols) != sorted(df.columns):
                failed.append(name)
                print(f"FAIL  {name} columns {sorted(df.columns)} vs {sorted(cols)}", flush=True)
            elif got != want:
                failed.append(name)
                diff = [(a, b) for a, b in zip(got, want) if a != b][:2]
                print(f"FAIL  {name} {len(got)} vs {len(want)} {sorted(cols)} {diff}", flush=True)
            else:
                print(f"OK    {name} {len(got)} {took:.1f}s sql {time.time() - start - took:.1f}s", flush=True)
        except Exception as e:  # report and go on with the next query
            failed.append(name)
            print(f"ERROR {name} {type(e).__name__}: {str(e)[:900]}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} fine; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
