"""Run every query and its SQL on the same tables and compare row by row.

``python -m checks.compare [sf_dir] [name ...]``
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES
from holdfast.workspace import use_local_folder

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_local_folder(spark)
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


_SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(spark, con, sf_dir: str, name: str) -> list[str]:
    """What differs between query and SQL; empty if nothing does."""
    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    want_types = {d[0]: str(d[1]) for d in cursor.description}
    want = _rows(columns, cursor.fetchall())
    out = []
    if sorted(columns) != sorted(df.columns):
        out.append(f"columns {sorted(df.columns)} / {sorted(columns)}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} / {len(want)}")
    for column, kind in df.dtypes:
        if _SAME_TYPE.get(kind) != want_types.get(column):
            out.append(f"{column}: {kind} / {want_types.get(column)}")
    unequal = [(g, w) for g, w in zip(got, want) if g != w]
    if unequal:
        out.append(f"{len(unequal)} unequal rows, first {unequal[0]}")
    return out


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark, con = session(), duck(sf_dir)
    failed = 0
    for name in names:
        started = time.monotonic()
        try:
            if name in ORACLE:
                found = differences(spark, con, sf_dir, name)
                verdict = "; ".join(found) if found else "equal"
            else:
                found, rows = [], QUERIES[name](spark, sf_dir).collect()
                verdict = f"{len(rows)} rows, no SQL: {rows[:1]}"
        except Exception as e:  # report and go on with the next query
            found, verdict = [e], f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(found)
        print(f"{name:28} {time.monotonic() - started:6.2f}s {verdict}", flush=True)
    print(f"{len(names) - failed} of {len(names)} passed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
