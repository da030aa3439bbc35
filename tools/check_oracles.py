"""Run registered queries against their DuckDB oracles.

    python tools/check_oracles.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusmill.session import get_session  # noqa: E402
from corpusmill.workloads import all_oracles, all_queries  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(plain(r[i])) for i in order) for r in rows)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = get_session()
    con = connect(args.sf)
    oracles, bad = all_oracles(), 0
    for name, query in all_queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            df = query(spark, args.sf)
            got = [tuple(r) for r in df.collect()]
            took = time.time() - start
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {name}: {str(error)[:900]}", flush=True)
            continue
        if name not in oracles:
            print(f"rows  {name}: {len(got)} rows, {took:.2f}s", flush=True)
            continue
        try:
            cursor = con.execute(oracles[name])
            columns = [c[0] for c in cursor.description]
            types = {c[0]: str(c[1]) for c in cursor.description}
            want = cursor.fetchall()
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"SQL   {name}: {str(error)[:600]}", flush=True)
            continue
        if sorted(columns) != sorted(df.columns):
            bad += 1
            print(f"COLS  {name}: spark {df.columns} sql {columns}", flush=True)
            continue
        a, b = rows_of(df.columns, got), rows_of(columns, want)
        same = a == b
        odd = [f"{n}:{t}/{types[n]}" for n, t in df.dtypes
               if (t, types[n]) not in {("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"),
                                        ("string", "VARCHAR"), ("boolean", "BOOLEAN"), ("date", "DATE")}]
        print(f"{'ok   ' if same else 'DIFF '} {name}: {len(got)}/{len(want)} rows, {took:.2f}s"
              + (f"  types {odd}" if odd else ""), flush=True)
        if not same:
            bad += 1
            set_a, set_b = set(a), set(b)
            only_a = [r for r in a if r not in set_b][:3]
            only_b = [r for r in b if r not in set_a][:3]
            print("   spark only", only_a, "\n   sql only  ", only_b, flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
