"""Medallion analytics on PySpark: change logs in, star schema and saved queries out."""
