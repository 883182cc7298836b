"""Compare every registered query with its SQL: python -m parity.check [dir] [name…] [key=value…]"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from tillwork.session import build_session

from .queries import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def differences(spark, con, name: str, sf_dir: str) -> tuple[int, list]:
    df = QUERIES[name](spark, sf_dir)
    order = sorted(df.columns)
    got = Counter(tuple(row) for row in df.select(*order).collect())
    cur = con.execute(SQL[name])
    names = [c[0] for c in cur.description]
    at = [names.index(c) for c in order]
    want = Counter(tuple(row[i] for i in at) for row in cur.fetchall())
    extra, missing = got - want, want - got
    sample = []
    if extra or missing:
        sample = [
            dict(zip(order, sorted(x, key=str)[0], strict=True)) if x else None
            for x in (extra, missing)
        ]
    return sum(got.values()), [sum(extra.values()), sum(missing.values()), *sample] if sample else []


def main(sf_dir: str, names: list[str]) -> int:
    # Further settings as key=value, to check that results do not depend on them.
    extra = dict(n.split("=", 1) for n in names if "=" in n)
    names = [n for n in names if "=" not in n]
    conf = {"spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8", "spark.ui.enabled": "false", **extra}
    spark = build_session("check", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or QUERIES:
        began = time.time()
        try:
            if name not in SQL:
                print(f"{name}: rows {QUERIES[name](spark, sf_dir).count()}, no SQL")
                continue
            rows, diff = differences(spark, con, name, sf_dir)
        except Exception as error:  # report and go on
            rows, diff = 0, [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name}: {rows} rows {time.time() - began:.1f}s", flush=True)
        for part in diff:
            print("     ", part)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(bool(main(where, sys.argv[2:])))
