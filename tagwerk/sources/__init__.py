"""Readers: delimited text by header name, JSON documents,
per-symbol directories, result directories, JDBC, notification streams."""
