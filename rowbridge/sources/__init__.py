"""Readers: tables and queries, JDBC, delimited text."""
