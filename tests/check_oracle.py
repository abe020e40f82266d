"""Compare every query with its oracle: python tests/check_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from workload import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def oracle(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(plain(r[i])) for i in order) for r in rows))


def compare(spark, con, sf_dir, name, check_frame=None):
    """None when equal, else a message."""
    df = QUERIES[name](spark, sf_dir)
    if check_frame is not None:
        check_frame(df)
    if name not in ORACLES:
        df.collect()
        return None
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want, got = normal(columns, found.fetchall()), normal(df.columns, df.collect())
    if want == got:
        return None
    extra, lack = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
    return f"rows {len(got)} != {len(want)}; only here {extra}; only there {lack}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    db = oracle(sf)
    for query_name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            problem = compare(session, db, sf, query_name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if problem is None else 'DIFF'} {query_name} {time.time() - start:.1f}s"
              f" {problem or ''}", flush=True)
