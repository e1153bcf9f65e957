"""Playbill: catalog analytics as plain Spark DataFrame operators."""
