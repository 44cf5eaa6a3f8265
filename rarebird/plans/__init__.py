"""Jobs (train / predict / bootstrap) and the registered checks run against DuckDB."""
