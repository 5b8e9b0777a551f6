"""Compares the registered queries with their SQL counterparts: python -m checks.compare [sf_dir] [name...]"""

import sys
import time

import duckdb
import pandas as pd

from checks.queries import ORACLES, QUERIES
from hazline.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    df = df.astype(object).where(df.notna(), None)
    return df.sort_values(list(df.columns), key=lambda c: c.map(repr)).reset_index(drop=True)


def difference(spark, sf_dir: str, name: str, con=None) -> str | None:
    """None where both sides agree in columns, types of values and all rows."""
    ours = normal(QUERIES[name](spark, sf_dir).toPandas())
    theirs = normal((con or connect(sf_dir)).execute(ORACLES[name]).df())
    if list(ours.columns) != list(theirs.columns):
        return f"columns {list(ours.columns)} / {list(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    unequal = (ours != theirs) & ~(ours.isna() & theirs.isna())
    if unequal.any(axis=None):
        rows = unequal.any(axis=1)
        return (
            f"{rows.sum()} of {len(ours)} rows differ in"
            f" {[c for c in ours.columns if unequal[c].any()]}\n"
            f"{ours[rows].head(5)}\n{theirs[rows].head(5)}"
        )
    return None


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    for key in sys.argv[2:] or ORACLES:
        start = time.time()
        try:
            found = difference(session, folder, key, db)
        except Exception as error:  # report all queries, also after a failing one
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{key:28s} {time.time() - start:6.1f}s  {found or 'equal'}", flush=True)
