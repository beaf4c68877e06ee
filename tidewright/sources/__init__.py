"""Sources: a description of where data lies to a lazy DataFrame."""

from tidewright.sources.files import read_files
from tidewright.sources.http_json import fetch_records, read_http_json
from tidewright.sources.jdbc import read_jdbc
from tidewright.sources.kafka import read_kafka
from tidewright.sources.tables import read_table

__all__ = ["fetch_records", "read_files", "read_http_json", "read_jdbc", "read_kafka", "read_table"]
