"""Run a query in Spark and its SQL in DuckDB and compare the rows as bags."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return None if math.isnan(number) else round(number, 6)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def open_duckdb(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def differences(spark_df, con, oracle: str) -> list[str]:
    """Empty when both engines give the same columns, types and rows."""
    found = []
    result = con.execute(oracle)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    if sorted(columns) != sorted(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} != {sorted(columns)}")
        return found
    for name, kind in spark_df.dtypes:
        same = {
            "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
        }.get(kind)
        if same != kinds[name]:
            found.append(f"type of {name}: {kind} / {kinds[name]}")
    mine = _bag(spark_df.columns, spark_df.collect())
    theirs = _bag(columns, rows)
    if mine != theirs:
        found.append(f"rows {sum(mine.values())} / {sum(theirs.values())}")
        found += [f"only in Spark: {r}" for r in list((mine - theirs).elements())[:3]]
        found += [f"only in SQL: {r}" for r in list((theirs - mine).elements())[:3]]
    return found
