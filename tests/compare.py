"""Spark against DuckDB, row by row, for all queries or the ones named.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf):
    con = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, Decimal):
        return f"{value:f}"
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, con, query, sf):
    """None if equal, else a short text."""
    df = query(spark, sf)
    ours = canonical(df.columns, df.collect())
    cursor = con.execute(query.sql)
    theirs = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} vs {theirs[0]}"
    if ours[1] != theirs[1]:
        a, b = set(ours[1]), set(theirs[1])
        return f"rows {len(ours[1])} vs {len(theirs[1])}; only ours {sorted(a - b)[:3]}; only theirs {sorted(b - a)[:3]}"
    return None


if __name__ == "__main__":
    from strata.queries import ALL
    from strata.session import local_session

    sf, names = sys.argv[1], sys.argv[2:] or list(ALL)
    spark, con, bad = local_session(8, "compare"), connect(sf), 0
    for name in names:
        begin = time.time()
        try:
            problem = difference(spark, con, ALL[name], sf)
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - begin:6.2f}s {problem or 'ok'}", flush=True)
    sys.exit(bool(bad))
