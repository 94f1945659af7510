"""Holds a query against its SQL in DuckDB, order aside."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _rows(frame: pd.DataFrame) -> list:
    def plain(x):
        if x is None or (not isinstance(x, (list, dict)) and pd.isna(x)):
            return None
        if isinstance(x, float) and x.is_integer():  # pandas holds whole numbers beside nulls as floats
            return int(x)
        return float(x) if isinstance(x, float) else int(x) if hasattr(x, "__index__") else str(x)

    return sorted(repr(tuple(plain(x) for x in r)) for r in frame[sorted(frame.columns)].itertuples(index=False, name=None))


def same(spark, sf_dir: str, query, sql: str) -> None:
    con = duckdb.connect()
    for t in filter(lambda t: os.path.exists(f"{sf_dir}/{t}.parquet"), TABLES):
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    ours, theirs = query(spark, sf_dir).toPandas(), con.execute(sql).fetchdf()
    assert set(ours.columns) == set(theirs.columns)
    assert _rows(ours) == _rows(theirs)
