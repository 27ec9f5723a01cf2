"""Run a catalog query on Spark and its SQL on DuckDB, and compare all values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def difference(frame, con, sql: str) -> str | None:
    """None when equal; else a short description."""
    columns = sorted(frame.columns)
    ours = sorted(tuple(cell(v) for v in row) for row in frame.select(*columns).collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {sorted(set(names) ^ set(columns))}"
    order = [names.index(c) for c in columns]
    theirs = sorted(tuple(cell(row[i]) for i in order) for row in cursor.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        parts = [f"{c}: {x} != {y}" for c, x, y in zip(columns, *wrong[0]) if x != y]
        return f"{len(wrong)} of {len(ours)} rows, first {wrong[0][0][:2]} {'; '.join(parts)}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from clickcohort.catalog import QUERIES
    from clickcohort.catalog_sql import ORACLES
    from clickcohort.session import build_session

    spark = build_session("local[8]", 8)
    con = connect(sf_dir)
    failed = 0
    for name in names or list(QUERIES):
        start = time.time()
        if name not in ORACLES:
            print(f"{name}: no oracle, {QUERIES[name](spark, sf_dir).count()} rows", flush=True)
            continue
        try:
            found = difference(QUERIES[name](spark, sf_dir), con, ORACLES[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__} {str(error)[:600]}"
        failed += found is not None
        print(f"{name}: {found or 'equal'} ({time.time() - start:.1f}s)", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
