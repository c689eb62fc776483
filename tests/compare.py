"""Run registered queries beside their SQL and compare the results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return repr(v)


def canonical_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows), sorted(names)


def compare(spark, con, name, query, sql, sf):
    """None when equal, else a short description of the difference."""
    df = query(spark, sf)
    got, got_names = canonical_rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want, want_names = canonical_rows([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} vs {len(want)}; only here {extra}; only in SQL {missing}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as E
    from catalogops.session import build

    sf = sys.argv[1]
    only = set(sys.argv[2:])
    spark = build("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.sql.ansi.enabled": "true", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, q in E.queries().items():
        if only and name not in only:
            continue
        sql, start = E.oracle_sql().get(name), time.time()
        try:
            if sql is None:
                result = f"rows only: {q(spark, sf).count()}"
            else:
                result = compare(spark, con, name, q, sql, sf) or "ok"
        except Exception as e:  # noqa: BLE001
            result = f"FAILED {type(e).__name__}: {str(e)[:1500]}"
        bad += not (result == "ok" or result.startswith("rows only"))
        print(f"{name:26s} {time.time() - start:6.2f}s {result}", flush=True)
    print("differences:", bad)
