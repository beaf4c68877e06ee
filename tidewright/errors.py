"""Errors raised before any data is touched."""


class JobError(ValueError):
    """A job definition is incomplete or contradictory."""


class SchemaMismatch(JobError):
    """A batch cannot be reconciled with the table it should be written to."""
