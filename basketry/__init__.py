"""Retail analytics on PySpark: cleaning, star schema, RFM, reports and models."""
