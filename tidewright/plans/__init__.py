"""Jobs: sources, steps and a sink, declared as data."""

from tidewright.plans.job import Job

__all__ = ["Job"]
