"""Spark-first analytics for retail price, promotion and text feeds."""
