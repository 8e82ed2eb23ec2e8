"""Run a registered query and its SQL side by side and describe the first difference."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def database(sf_dir: str):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(
        (tuple(plain(row[at]) for at in order) for row in rows), key=lambda row: tuple(str(part) for part in row)
    )


def difference(spark, connection, query, sql, sf_dir):
    frame = query(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} / {sorted(names)}"
    if len(got) != len(want):
        extra = [row for row in got if row not in set(want)][:2] if len(got) < 50000 else ""
        lost = [row for row in want if row not in set(got)][:2] if len(want) < 50000 else ""
        return f"{len(got)} rows / {len(want)} rows; only here {extra}; only there {lost}"
    for left, right in zip(got, want):
        if left != right:
            return f"{left} / {right}"[:2000]
    return None if got else "no rows"
