"""JSON documents behind URLs, fetched by executors."""

from __future__ import annotations

import json
import sys
import urllib.request
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructType

from tidewright.names import require
from tidewright.work import new_folder, stage

# The fetching code travels with the job, so executors need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What a task holds of documents before it hands them on; one document is never cut.
_BATCH_BYTES, _BATCH_ROWS = 4 << 20, 1_000


def fetch_records(
    df: DataFrame,
    url: str | Column,
    schema: StructType | str | None = None,
    headers: Mapping[str, str] | None = None,
    timeout: float = 60.0,
    parallelism: int | None = None,
) -> DataFrame:
    """One row per JSON record found at the URLs of ``df``.

    A document is a list of records or one record. The requests of a partition
    run one after the other: ``parallelism``, or else the partitioning of
    ``df``, says how many are open at a time. An answer other than success
    fails the task, which Spark tries again. Documents are fetched once, as they
    are, into the shared folder; without a ``schema`` it is inferred there.
    """
    sent = dict(headers or {})

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _fetched(batches, sent, timeout)

    source = F.col(url) if isinstance(url, str) else url
    urls = df.select(source.alias("url"))
    if parallelism:
        urls = urls.repartition(parallelism)
    documents = stage(urls.mapInPandas(fetch, "url string, value string")).select("value")
    return _records(documents, schema)


def _fetched(
    batches: Iterator[pd.DataFrame], headers: Mapping[str, str], timeout: float, batch_bytes: int = _BATCH_BYTES
) -> Iterator[pd.DataFrame]:
    """The documents behind the URLs, handed over whenever they come to ``batch_bytes``."""
    held, size = [], 0
    for batch in batches:
        for address in batch["url"]:
            request = urllib.request.Request(address, headers=dict(headers))
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                body = answer.read()
            held.append((address, body.decode(json.detect_encoding(body))))
            size += len(body)
            if size >= batch_bytes or len(held) >= _BATCH_ROWS:
                yield pd.DataFrame(held, columns=["url", "value"])
                held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=["url", "value"])


def _records(documents: DataFrame, schema: StructType | str | None) -> DataFrame:
    """The records of staged documents, ``value``, each a list of records or one record."""
    spark = documents.sparkSession
    if schema is None:
        # Line breaks inside strings are escaped in JSON, so those left are white space.
        lines = documents.select(F.translate("value", "\r\n", "  ").alias("value"))
        folder = new_folder(spark, "http")
        lines.write.text(folder)
        return spark.read.json(folder)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    # A document of one record is read as a list of one.
    records = F.from_json("value", ArrayType(schema), {"mode": "FAILFAST"})
    return documents.select(F.inline(records))


def read_http_json(
    spark: SparkSession,
    url: str | Sequence[str],
    schema: StructType | str | None = None,
    headers: Mapping[str, str] | None = None,
    pages: Mapping[str, int] | None = None,
    timeout: float = 60.0,
    parallelism: int = 8,
    next: str | None = None,
    records: str | None = None,
) -> DataFrame:
    """The records at one URL, at several, or at a URL with ``{page}`` in it.

    ``pages`` holds the first and the last page number. At most
    ``parallelism`` requests are open at a time. ``next``, a JSON path, is where a document has the address
    of the document that follows it: those are fetched in rounds of tasks, until no document names
    one that was not fetched before. ``records``, a JSON path, is where the records are, the whole document if not given.
    """
    require(url, "http source", "url")
    if pages:
        numbers = spark.range(int(pages["first"]), int(pages["last"]) + 1)
        urls = numbers.select(F.replace(F.lit(url), F.lit("{page}"), F.col("id").cast("string")).alias("url"))
    else:
        listed = [url] if isinstance(url, str) else list(url)
        urls = spark.createDataFrame([(one,) for one in listed], "url string")
        parallelism = min(parallelism, len(listed))
    if next is None and records is None:
        return fetch_records(urls, "url", schema, headers, timeout, parallelism)
    return _records(_chained(urls, headers or {}, timeout, parallelism, next, records or "$"), schema)


def _chained(
    urls: DataFrame, headers: Mapping[str, str], timeout: float, parallelism: int, next: str | None, records: str
) -> DataFrame:
    """The records' part of all documents that can be reached, as ``value``. Each round is staged."""
    sent = dict(headers)

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _fetched(batches, sent, timeout)

    found, wanted = None, urls.distinct()
    while True:
        documents = stage(wanted.repartition(parallelism).mapInPandas(fetch, "url string, value string"))
        found = documents if found is None else found.unionByName(documents)
        if next is None:
            break
        links = documents.select(F.get_json_object("value", next).alias("url")).where("url is not null").distinct()
        wanted = stage(links.join(found.select("url"), "url", "left_anti"))
        if wanted.first() is None:
            break
    return found.select(F.get_json_object("value", records).alias("value")).where("value is not null")
