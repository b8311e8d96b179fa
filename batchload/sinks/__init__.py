"""Sinks: JDBC tables, catalog tables and batch-partitioned files."""
