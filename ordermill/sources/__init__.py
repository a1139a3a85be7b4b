"""Sources and sinks: CSV text, message streams, parquet tables, and the
stand-ins that shape the driver's test tables into the raw order layer."""
