"""Sources and sinks: yearly CSV layouts, totals CSV, driver parquet tables."""
