"""Landing files and versioned Parquet tables."""
