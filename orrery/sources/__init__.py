"""Inputs and outputs: fixture projections of the driver tables, text and
Parquet files, the versioned table catalogue and reject log, JDBC helpers."""
