"""Outputs: Parquet (plain and month-partitioned), report CSV, gzip CSV
clustered by key, JSON."""
