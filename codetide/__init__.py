"""Activity analytics over public code-hosting event logs, as PySpark DataFrames."""
