"""Retail line analytics as composable PySpark DataFrame steps."""
