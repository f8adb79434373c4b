"""Run registered queries and their SQL side by side; usable as a script over any data folder."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "as_tuple") or isinstance(value, (int, float)):
        number = float(value)
        return None if math.isnan(number) else round(number, 9) + 0.0
    return str(value)


def _normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, sf: str, query, sql: str) -> list[str]:
    """Empty when both sides agree in columns and rows."""
    df = query(spark, sf)
    got_names, got = _normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names, want = _normal([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    out = [f"rows {len(got)} != {len(want)}"] if len(got) != len(want) else []
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if not want:
        out.append("no rows at all")
    return out + [f"{len(bad)} differ, first {bad[0]}"] if bad else out


def main(sf: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from kbvec.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false",
                                                "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = duck(sf), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            found = (differences(spark, con, sf, query, sqls[name]) if name in sqls
                     else [] if query(spark, sf).collect() else ["no rows at all"])
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
