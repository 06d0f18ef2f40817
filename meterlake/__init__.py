"""Layered lakehouse over metered time series, built on plain PySpark and parquet."""
