"""Operators: functions from DataFrames to DataFrames, without side effects."""
