"""Layer builders and reports. Builders take and return DataFrames and run nothing."""
