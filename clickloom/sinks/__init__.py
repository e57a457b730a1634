"""Writers: upserts, partition overwrites and table fan-out on plain parquet."""
