"""DataFrame operators: functions from DataFrames to DataFrames."""
