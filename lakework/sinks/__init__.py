"""Writers: CSV, JSON, Parquet, JDBC and the layer layout."""
