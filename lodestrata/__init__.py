"""Data-loading, history-keeping and reporting operators for Spark DataFrames."""
