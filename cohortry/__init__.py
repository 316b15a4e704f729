"""Cohort evidence analytics as plain Spark DataFrame operators."""
