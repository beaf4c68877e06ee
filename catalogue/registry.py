"""Registering queries, and the pieces they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewright import Job

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function under its name, with SQL giving the same rows."""

    def add(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle.strip()
        return function

    return add


def files(sf_dir: str, *tables: str) -> list[dict]:
    return [{"name": table, "source_type": "file", "path": f"{sf_dir}/{table}.parquet"} for table in tables]


def job(sf_dir: str, tables: str, *steps: dict, **settings) -> Job:
    """A job over the named tables; the first is the default source."""
    return Job.from_dict({"sources": files(sf_dir, *tables.split()), "transforms": list(steps), **settings})


def step(kind: str, **settings) -> dict:
    return {"transform_type": kind, **settings}


def result(spark: SparkSession, sf_dir: str, tables: str, *steps: dict, **settings) -> DataFrame:
    return job(sf_dir, tables, *steps, **settings).result(spark)
