"""Dataset registry, typed readers, Parquet writer, scratch tables."""
