"""Operators: functions from DataFrame to DataFrame, lazy, without driver loops."""
