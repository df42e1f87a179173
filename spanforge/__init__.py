"""Interval, hit-table and evidence analytics as Spark DataFrame operators."""
