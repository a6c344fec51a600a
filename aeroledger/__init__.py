"""Spark-first operations and revenue analytics for transport data.

Every operator takes DataFrames plus column names and returns a lazy
DataFrame; nothing runs until the caller triggers an action.
"""
