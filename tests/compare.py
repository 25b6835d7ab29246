"""Runs named queries in Spark and DuckDB on the same tables and compares all rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    return float(value) if value.__class__.__name__ == "Decimal" else value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(plain, key=repr)


def difference(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None if both give the same rows, else a short description."""
    df = query(spark, sf_dir)
    ours = _rows(df.columns, df.collect())
    result = con.execute(sql)
    theirs = _rows([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if not ours[1]:
        return "no rows"
    if ours[1] == theirs[1]:
        return None
    mine, other = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
    return (f"{len(ours[1])} / {len(theirs[1])} rows; only Spark {len(mine)} "
            f"{sorted(mine, key=repr)[:2]}; only SQL {len(other)} {sorted(other, key=repr)[:2]}")


if __name__ == "__main__":
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from roadpulse.plans.oracles import ORACLES
    from roadpulse.plans.queries import QUERIES
    from roadpulse.session import build_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", settings={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in chosen:
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, QUERIES[name], ORACLES[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {str(problem or "ok")[:700]}", flush=True)
