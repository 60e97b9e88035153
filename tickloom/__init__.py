"""Market-bar analytics on Spark: ingestion, indicators, signals, variant scoring and marts."""
