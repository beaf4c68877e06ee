"""Job descriptions of every kind, and what they ask of readers absent here."""

import pytest

from tidewright import Job, JobError
from tidewright.plans.job import read

PARTS = {"name": "parts", "source_type": "file", "format": "orc", "path": "/lake/parts"}
DUMP = {"sink_type": "file", "format": "json", "path": "/lake/dump", "mode": "append"}

SHAPES = {
    "copy": {"sources": [PARTS], "sink": DUMP},
    "two sources": {
        "sources": [PARTS, {"name": "bins", "source_type": "catalog", "database": "stock", "table": "bins"}],
        "transforms": [{"transform_type": "join", "right": "bins", "on": "part_no", "how": "left_anti"}],
        "mask_pii": ["PHONE_NUMBER", "IP_ADDRESS"],
        "sink": DUMP,
    },
    "table": {
        "sources": [PARTS],
        "sink": {"sink_type": "iceberg", "database": "stock", "table": "parts", "fill_nulls": False, "partition_by": ["bin"]},
    },
    "stream": {
        "sources": [{"name": "scans", "source_type": "kafka", "connection_url": "k1:9092,k2:9092", "topic": "scans",
                     "options": {"startingOffsets": "earliest"}}],
        "transforms": [{"transform_type": "add_column", "name": "body", "expression": "CAST(value AS STRING)"}],
        "sink": DUMP,
    },
    "pages of answers": {
        "sources": [{"name": "prices", "source_type": "api", "url": "https://prices.example.net/v2"}],
        "sink": DUMP,
    },
    "database": {
        "sources": [{"name": "bins", "source_type": "jdbc", "connection_url": "jdbc:db2:stock", "table": "bins"}],
        "sink": {"sink_type": "jdbc", "connection_url": "jdbc:db2:copy", "table": "bins", "mode": "append"},
    },
    "by month": {"sources": [PARTS], "sink": DUMP, "partition_by": ["month"], "create_timestamp": True,
                 "partition_timestamp_column": "counted_at"},
}


@pytest.mark.parametrize("name", SHAPES)
def test_shapes_are_accepted(name):
    job = Job.from_dict({"job_type": "any", **SHAPES[name]})
    assert job.default_source == SHAPES[name]["sources"][0]["name"] and job.sink is not None


def test_defaults():
    job = Job.from_dict({"sources": [{"name": "a", "source_type": "s3", "path": "p", "format": None}],
                         "sink": {"sink_type": "table", "database": "d", "table": "t"}, "partition_by": ["year"]})
    assert job.sources[0].format == "parquet" and job.sink.mode == "overwrite" and job.sink.fill_nulls
    assert job._effective_sink().partition_by == ["year"]
    assert Job.from_dict({"sink": DUMP, "partition_by": ["year"]})._effective_sink().partition_by == ()
    assert Job().default_source == "source"


class Reader:
    """Stands in for a session and notes what its reader is asked for."""

    def __init__(self):
        self.calls = []
        self.read = self

    def __getattr__(self, name):
        return lambda *given, **options: self.calls.append((name, *given, options)) or self


def asked(shape):
    reader = Reader()
    read(reader, Job.from_dict(SHAPES[shape]).sources[0])
    return reader.calls


def test_database_reader():
    assert asked("database") == [
        ("format", "jdbc", {}),
        ("options", {"url": "jdbc:db2:stock", "dbtable": "bins"}),
        ("load", {}),
    ]


def test_stream_reader():
    assert asked("stream") == [
        ("format", "kafka", {}),
        ("options", {"kafka.bootstrap.servers": "k1:9092,k2:9092", "subscribe": "scans", "startingOffsets": "earliest"}),
        ("load", {}),
    ]


@pytest.mark.parametrize("source", [
    {"source_type": "s3"}, {"source_type": "jdbc"}, {"source_type": "catalog", "database": "d"},
    {"source_type": "kafka", "topic": "t"}, {"source_type": "api"}])
def test_required_settings(source):
    with pytest.raises(JobError):
        read(Reader(), Job.from_dict({"sources": [{"name": "s", **source}]}).sources[0])


def test_secrets_are_given_by_the_caller():
    with pytest.raises(JobError, match="secret_id"):
        Job.from_dict({"sources": [{"name": "s", "source_type": "jdbc", "table": "t", "secret_id": "x"}]})


def test_database_url_and_credentials():
    reader = Reader()
    source = {"name": "bins", "source_type": "jdbc", "connection_type": "mysql", "database": "stock", "table": "bins",
              "auth": {"rds_iam": {"host": "db1", "port": 3306, "username": "reader"}, "password": "word"}}
    read(reader, Job.from_dict({"sources": [source]}).sources[0])
    assert reader.calls[1] == ("options", {
        "url": "jdbc:mysql://db1:3306/stock", "dbtable": "bins", "user": "reader", "password": "word", "ssl": "true",
        "sslmode": "require"})


def test_imported_modules():
    from tidewright.plans.job import _imported

    import math

    assert _imported([{"name": "math"}, {"name": "sqrt", "from": "math"}]) == {"math": math, "sqrt": math.sqrt}
    with pytest.raises(JobError):
        _imported([{"name": "no_such_module"}])
