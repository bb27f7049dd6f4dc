"""Run registered queries against DuckDB and compare whole results."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    made = [tuple(repr(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(made)


def difference(spark_df, con, sql) -> str | None:
    """None when equal, else a short description."""
    found = con.execute(sql)
    names, expected = canonical([d[0] for d in found.description], found.fetchall())
    got_names, got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_names != names:
        return f"columns {got_names} vs {names}"
    if len(got) != len(expected):
        return f"{len(got)} rows vs {len(expected)}"
    for ours, theirs in zip(got, expected):
        if ours != theirs:
            cells = [(n, a, b) for n, a, b in zip(names, ours, theirs) if a != b]
            return f"first difference {cells[:4]}"
    return None


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from emberscan.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            problem = difference(df, con, oracles[name]) if name in oracles else "no oracle"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
