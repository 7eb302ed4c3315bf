"""Audit, categorisation and extraction of large event tables, as Spark DataFrame operators."""
