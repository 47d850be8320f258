"""Delimited files in, month-partitioned tables in and out."""
