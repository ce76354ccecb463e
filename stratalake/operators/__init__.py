"""DataFrame operators: joins, deduplication, aggregates, merges, version history, checks."""
