"""Warehouse benchmark suites, retail generation and run analytics on PySpark."""
