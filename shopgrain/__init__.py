"""Retail medallion analytics as plain PySpark DataFrame functions."""
