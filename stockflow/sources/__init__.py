"""Readers: contract tables from CSV or Parquet, and views over the test tables."""
