"""Inputs: the driver's Parquet tables, the raw relations derived from them,
typed CSV / gzip parts / Parquet readers, packaged SQL and file inventory."""
