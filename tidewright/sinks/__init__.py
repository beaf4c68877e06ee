"""Sinks: where the result of a job is written."""

from tidewright.sinks.evolving import write_evolving_table
from tidewright.sinks.files import write_files
from tidewright.sinks.jdbc import write_jdbc
from tidewright.sinks.tables import append_to_table

__all__ = ["append_to_table", "write_evolving_table", "write_files", "write_jdbc"]
