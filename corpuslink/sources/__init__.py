"""Sources and sinks: landed files in, Parquet and documents out."""
