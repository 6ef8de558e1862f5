"""Sources and sinks: parquet tables, CSV ingest, stored tables."""
