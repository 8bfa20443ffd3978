"""Configuration-driven medallion tables on plain Apache Spark.

Every operator is a function from DataFrames to a DataFrame built from Spark SQL
expressions. Nothing here holds a session or reads configuration at import time.
"""
