"""Run registered queries against DuckDB: python -m tests.oracle <folder> [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from assay.queries.base import TABLES


def duck_connection(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return str(v)


def flat(names: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(con, df, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    got_names = df.columns
    got = flat(got_names, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want_names = rel.columns
    want = flat(want_names, rel.fetchall())
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} vs {sorted(want_names)}"
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    duck_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    off = {n: (t, duck_types[n]) for n, t in spark_types.items() if names.get(t, t) != duck_types[n]}
    if off:
        return f"types {off}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} rows differ, order {sorted(got_names)}\n  got  {bad[0][0]}\n  want {bad[0][1]}"
    return None if got else "no rows"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(folder)
    sql = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            if name in sql:
                why = compare(con, fn(spark, folder), sql[name])
            else:
                n = len(fn(spark, folder).collect())
                why = None if n else "no rows"
        except Exception as e:  # noqa: BLE001
            why = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += why is not None
        print(f"{'ok  ' if why is None else 'FAIL'} {name} {time.time() - t:.1f}s {'' if name in sql else '(rows only)'} {why or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
