"""Compare registered queries with their SQL counterparts.

python -m tests.compare [folder] [query ...] prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normalised(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(None if pd.isna(v) else str(v) for v in row)
        for row in frame.astype(object).itertuples(index=False, name=None)
    ]
    return sorted(rows, key=repr)


def differences(spark_df, con, sql: str) -> str | None:
    """None if both give the same columns, types and rows, else what differs."""
    expected = con.sql(sql).to_arrow_table()
    actual = spark_df.toArrow()
    if sorted(actual.column_names) != sorted(expected.column_names):
        return f"columns {actual.column_names} != {expected.column_names}"
    # Arrow spells the same value type differently: text sizes, time units.
    spell = {"large_string": "string"}
    for name in actual.column_names:
        left, right = (str(t.schema.field(name).type) for t in (actual, expected))
        if spell.get(left, left) != spell.get(right, right):
            return f"type of {name}: {left} != {right}"
    left, right = (
        normalised(pd.DataFrame({c: t.column(c).to_pylist() for c in t.column_names}, dtype=object))
        for t in (actual, expected)
    )
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from parceltrail.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if name not in oracles or argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            result = query(spark, sf_dir)
            problem = differences(result, con, oracles[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    sys.exit(main(sys.argv[1:]))
