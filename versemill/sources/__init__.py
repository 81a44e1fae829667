"""Source configuration, scans and persisted tables."""
