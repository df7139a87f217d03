"""Run registered queries next to their SQL twin in DuckDB and compare."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def spark_session(cores: int = 8, partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("proteoframe.scan.partitions", str(partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet{"/*" if os.path.isdir(f"{sf_dir}/{t}.parquet") else ""}'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].astype("float64")
        elif pd.api.types.is_integer_dtype(df[c]):
            df[c] = df[c].astype("int64" if df[c].notna().all() else "float64")
        else:
            df[c] = df[c].astype("object").where(df[c].notna(), None)
    if len(df.columns) and len(df):
        df = df.sort_values(list(df.columns), na_position="first", key=lambda s: s.astype(str))
    return df.reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when equal, else a short account of the first difference."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        if str(a[c].dtype) != str(b[c].dtype):
            return f"type of {c}: {a[c].dtype} != {b[c].dtype}"
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = int((~same).idxmax())
            return f"{(~same).sum()} differ in {c}: {a.loc[i].to_dict()} != {b.loc[i].to_dict()}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con = spark_session(), connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in queries:
        module = getattr(queries[name], "module", "")
        if wanted and not any(w in name or w == module for w in wanted):
            continue
        try:
            t0 = time.time()
            got = queries[name](spark, sf_dir).toPandas()
            t1 = time.time()
            if name not in sql:
                print(f"rows-only {name}: {len(got)} rows, spark {t1 - t0:.1f}s", flush=True)
                continue
            want = con.execute(sql[name]).df()
            t2 = time.time()
            diff = difference(got, want)
            bad += diff is not None
            print(f"{'OK  ' if diff is None else 'DIFF'} {name}: {len(got)} rows, "
                  f"spark {t1 - t0:.1f}s duckdb {t2 - t1:.1f}s {diff or ''}", flush=True)
        except Exception as e:  # report and go on with the next query
            bad += 1
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:1500]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    sys.path.insert(0, ".")
    main()
