"""Every operator as a query over the test tables, with the SQL that it must equal."""

from tremor.checks.inputs import AS_OF, Query
from tremor.checks.registry import oracle_sql, queries

__all__ = ["AS_OF", "Query", "oracle_sql", "queries"]
