"""Functions on schemas and columns."""
