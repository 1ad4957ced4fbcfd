"""Run registered queries on Spark and DuckDB and compare all values.

    python -m checks.compare SF_DIR [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.registry import queries

TABLES = ("orders", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a fixed order, numbers as floats, NULLs alike."""
    out = pd.DataFrame(index=df.index)
    for c in sorted(df.columns):
        v = df[c]
        numeric = pd.api.types.is_numeric_dtype(v) and not pd.api.types.is_bool_dtype(v)
        out[c] = v.astype("float64").round(6) if numeric else v.astype("object").where(v.notna(), None)
    keys = out.astype("string").fillna("")
    order = keys.sort_values(list(keys.columns), kind="stable").index
    return out.loc[order].reset_index(drop=True)


def difference(spark_rows: pd.DataFrame, duck_rows: pd.DataFrame) -> str | None:
    """What differs first, or None."""
    if sorted(spark_rows.columns) != sorted(duck_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(duck_rows.columns)}"
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} != {len(duck_rows)}"
    try:
        pd.testing.assert_frame_equal(normal(spark_rows), normal(duck_rows), check_dtype=False, rtol=0, atol=2e-6)
    except AssertionError as e:
        return str(e)
    return None


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), oracle_sql()
    bad = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        mine = run(spark, sf_dir).toPandas()
        took = time.time() - start
        problem = difference(mine, con.execute(sql[name]).fetchdf())
        bad += problem is not None
        print(f"{name}: {problem or 'ok'} ({len(mine)} rows, {took:.1f} s)", flush=True)
    print(f"{bad} differ", flush=True)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
