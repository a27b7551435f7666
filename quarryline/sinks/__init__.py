"""Writers: period-partitioned Parquet landed once."""
