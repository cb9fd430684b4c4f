"""Procurement-concentration analytics as plain PySpark DataFrame operators."""
