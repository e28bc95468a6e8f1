"""Workforce, sales and customer analytics as Spark DataFrame operators."""
