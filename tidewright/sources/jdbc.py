"""Databases reached through JDBC."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidewright.errors import JobError
from tidewright.names import require


def jdbc_options(
    table: str,
    connection_url: str | None = None,
    connection_type: str | None = None,
    database: str | None = None,
    auth: Mapping | None = None,
    options: Mapping[str, object] | None = None,
) -> dict[str, str]:
    """Options shared by reading and writing.

    Without ``connection_url`` the address comes from ``connection_type``,
    ``database`` and the host and port in ``auth``. Credentials go over an
    encrypted connection only. ``options`` is passed on: give
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    to read a large table in parallel.
    """
    require(table, "jdbc", "table")
    account = dict(auth or {})
    account = {**account, **account.pop("rds_iam", {})}
    if not connection_url:
        if not (account.get("host") and account.get("port")):
            raise JobError("jdbc: 'connection_url' is required when 'auth' names no host and port")
        require(connection_type, "jdbc", "connection_type")
        require(database, "jdbc", "database")
        connection_url = f"jdbc:{connection_type}://{account['host']}:{account['port']}/{database}"
    settings = {"url": connection_url, "dbtable": table}
    settings.update({key: _text(value) for key, value in (options or {}).items()})
    user = account.get("user") or account.get("username")
    if user and account.get("password"):
        settings.update(user=user, password=account["password"], ssl="true", sslmode="require")
    return settings


def _text(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def read_jdbc(spark: SparkSession, columns: Sequence[str] = (), **description) -> DataFrame:
    options = jdbc_options(**description)
    given = {name.lower() for name in options}
    if not given & {"partitioncolumn", "query"} and options.get("numPartitions") != "1":
        # One connection and one task read it all; numPartitions 1 says that this is meant.
        warnings.warn(f"jdbc: '{options['dbtable']}' has no partitionColumn and is read in one task", stacklevel=2)
    df = spark.read.format("jdbc").options(**options).load()
    return df.select(*columns) if columns else df
