"""Retail sales history and forecasting features as Spark DataFrame operators."""
