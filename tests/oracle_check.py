"""Run a query and its SQL side by side and compare their rows."""

import glob
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def canonical(frame):
    def one(v):
        if v is None or v != v:
            return "~"
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted("|".join(one(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False))


def agree(spark, folder, query, sql):
    ours, theirs = query(spark, folder).toPandas(), connect(folder).execute(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)
