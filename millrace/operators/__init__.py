"""Operators: functions from DataFrames to DataFrames, driven by rules and specs."""
