"""Run registered queries on both engines and compare their rows."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def sorted_rows(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [names[i] for i in order], sorted(picked, key=repr)


def difference(spark, connection, sf_dir: str, name: str) -> str | None:
    """A description of the first difference, or None."""
    frame = entry.queries()[name](spark, sf_dir)
    ours = sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if ours[1] else "no rows"
    result = connection.execute(sql)
    theirs = sorted_rows([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}; first {ours[1][:2]} against {theirs[1][:2]}"
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1]) if repr(a) != repr(b)]
    if wrong:
        return f"{len(wrong)} of {len(ours[1])} rows, such as {ours[0]}\n  {wrong[0][0]}\n  {wrong[0][1]}"
    return None if ours[1] else "no rows on either side"


def main() -> None:
    from plumbline.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = build_session(
        "compare",
        "local[8]",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=8,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in entry.queries():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            wrong = difference(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        mark = "rows" if name not in entry.oracle_sql() else "sql"
        print(f"{'ok  ' if wrong is None else 'FAIL'} {name} [{mark}] {time.time() - start:.2f}s", flush=True)
        if wrong:
            failures += 1
            print("    " + wrong, flush=True)
    print(f"{failures} failures")


if __name__ == "__main__":
    main()
