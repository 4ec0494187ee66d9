"""Data-processing operators: functions from DataFrame to DataFrame."""
