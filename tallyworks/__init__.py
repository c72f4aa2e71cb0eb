"""Batch analytics operators over DataFrames, planned and run by Spark."""
