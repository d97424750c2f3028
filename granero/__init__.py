"""Granero: retail e-commerce analytics as Spark DataFrame operators."""
