"""Independent SQL for every registered query, run by DuckDB on the same tables.

The SQL states the semantics directly (LAG/LEAD periods, left range joins, distinct counts), not the
shapes the Spark plans use.
"""
