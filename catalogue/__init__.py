"""Queries that exercise every source, step and sink on the test tables.

Each is paired with SQL that gives the same rows, except where only the
number of rows is defined.
"""

from catalogue import connectors, masking, registry, relational, scale, tables, windows  # noqa: F401

QUERIES, ORACLES = registry.QUERIES, registry.ORACLES
