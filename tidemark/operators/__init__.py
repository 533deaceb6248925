"""DataFrame operators: series, enrichment, upsert, incremental merge,
quality checks and profiling."""
