"""Reading and writing: tolerant Parquet, strict CSV, JDBC, run layouts and manifests, snapshot publishing."""
