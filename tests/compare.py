"""Rows of a Spark result and of the same SQL in DuckDB, ready to compare."""

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir):
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    return value


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple((type(v := _plain(row[i])).__name__, repr(v)) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain)


def spark_rows(df):
    return _table(df.columns, df.collect())


def oracle_rows(connection, sql):
    relation = connection.sql(sql)
    return _table(relation.columns, relation.fetchall())
