"""Batch jobs over body- and hand-landmark recordings, expressed as PySpark DataFrames."""
