"""Table operators: spatial join, lookups, dedup, incremental writes, quality, profiles."""
