"""Reading and writing: Parquet tables, landing files, CSV exchange, run logs."""
