"""Sources: driver-table fixture, CSV/Parquet scans, sinks."""
