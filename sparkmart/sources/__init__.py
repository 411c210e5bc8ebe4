"""Raw document readers and the parquet table store."""
