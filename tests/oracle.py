"""Run queries next to their SQL and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p if p.is_file() else p / '*.parquet'}'")
    return c


def plain(v):
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return f"{v:.6f}"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def rows(columns: list[str], data) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


def compare(spark, name: str, sf_dir: str, queries: dict, sql: dict, con=None) -> str:
    """Empty if equal, else what differs."""
    df = queries[name](spark, sf_dir)
    got = rows(df.columns, df.collect())
    con = con or connect(sf_dir)
    cur = con.execute(sql[name])
    columns = [d[0] for d in cur.description]
    want = rows(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if got == want:
        return ""
    a, b = set(got), set(want)
    return f"{len(got)} rows against {len(want)}; only here {sorted(a - b)[:3]}; only in SQL {sorted(b - a)[:3]}"


if __name__ == "__main__":
    import time

    from pyspark.sql import SparkSession

    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as e

    sf = sys.argv[1]
    conf = {"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.session.timeZone": "UTC"}
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    q, s = e.queries(), e.oracle_sql()
    con = connect(sf)
    for n in [x for x in q if not sys.argv[2:] or any(x.startswith(p) for p in sys.argv[2:])]:
        t = time.time()
        try:
            said = compare(spark, n, sf, q, s, con) if n in s else f"no SQL, {q[n](spark, sf).count()} rows"
        except Exception as x:
            said = f"ERROR {str(x)[:600]}"
        print(f"{n}: {said or 'ok'} ({time.time() - t:.1f} s)", flush=True)
