"""Run every query and compare it with its SQL in DuckDB: python tools/check.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def type_name(t: str) -> str:
    t = t.lower()
    return {"varchar": "string", "long": "bigint", "integer": "int", "timestamp_ntz": "timestamp"}.get(t, t)


def rows_of(table) -> list[tuple]:
    def norm(v):
        if isinstance(v, float) and v == 0:
            return 0.0
        return v
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    return sorted((tuple(norm(v) for v in r) for r in zip(*cols)), key=repr)


def compare(spark_df, con, sql: str) -> str:
    """'' if names, types, row count and every value agree, else what differs."""
    result = con.sql(sql)
    want_types = {n: type_name(str(t)) for n, t in zip(result.columns, result.types)}
    got_types = {f.name: type_name(f.dataType.simpleString()) for f in spark_df.schema}
    if set(want_types) != set(got_types):
        return f"columns {sorted(got_types)} vs {sorted(want_types)}"
    want, got = rows_of(result.to_arrow_table()), rows_of(spark_df.toArrow())
    notes = [f"type {n}: {got_types[n]} vs {want_types[n]}" for n in want_types if got_types[n] != want_types[n]]
    if len(want) != len(got):
        notes.insert(0, f"rows {len(got)} vs {len(want)}")
    elif want != got:
        i = next(i for i, (a, b) in enumerate(zip(got, want)) if a != b)
        diff = sum(a != b for a, b in zip(got, want))
        notes.insert(0, f"{diff} of {len(got)} rows differ, e.g. {str(got[i])[:300]} vs {str(want[i])[:300]}")
    return "; ".join(notes)


def main() -> int:
    from catalog import load_all
    from martkit.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name, e in load_all().items():
        if args and name not in args:
            continue
        t = time.time()
        try:
            df = e.run(spark, sf_dir)
            problem = compare(df, con, e.sql) if e.sql else f"no SQL, {df.count()} rows"
        except Exception as ex:  # noqa: BLE001
            problem = "error " + str(ex).split("JVM stacktrace")[0][:600]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - t:6.2f}s {name} {problem}", flush=True)
    print(f"{bad} problems")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
