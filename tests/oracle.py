"""Runs registered queries next to their oracle SQL; also usable from the command line."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

from periodica.workload.views import GIVEN


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        raise TypeError("decimals must be cast before comparing")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, list):
        return repr([_plain(x) for x in value])
    return repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, folder) -> str | None:
    """None when equal, else what differs."""
    df = query.run(spark, folder)
    ours = table(df.columns, [tuple(r) for r in df.collect()])
    text = query.oracle()
    if text is None:
        return None if ours[1] else "no rows"
    result = con.execute(text)
    theirs = table([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] != theirs[1]:
        mine, other = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
        return f"rows {len(ours[1])} != {len(theirs[1])}; ours {sorted(mine)[:2]} theirs {sorted(other)[:2]}"
    return None if ours[1] else "both empty"


def main() -> int:
    from periodica import build_session
    from periodica.workload.registry import load

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("oracle", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
                          spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, query in load().items():
        if len(sys.argv) > 1 and name not in sys.argv[1:]:
            continue
        begun = time.time()
        try:
            problem = compare(spark, con, name, query, folder)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - begun:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
