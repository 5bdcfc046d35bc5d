"""Layered sales analytics on PySpark: raw files -> clean sales -> customer segments."""
