"""Sources and sinks: driver tables, CSV/Parquet observation files, models."""
