"""Operators: functions from DataFrame to DataFrame, lazy unless stated."""
