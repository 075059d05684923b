"""Sources: raw JSON drops, Parquet zones, JDBC dimensions, seeds and the test-data adapter."""
