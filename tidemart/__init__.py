"""Retail lakehouse analytics as composable PySpark DataFrame operators."""
