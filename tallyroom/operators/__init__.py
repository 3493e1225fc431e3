"""Report, audit and cleaning operators: functions from DataFrames to a lazy DataFrame."""
