"""Declarative data jobs, run directly as Spark DataFrames."""

from tidewright.errors import JobError, SchemaMismatch
from tidewright.plans.job import Job

__all__ = ["Job", "JobError", "SchemaMismatch"]
