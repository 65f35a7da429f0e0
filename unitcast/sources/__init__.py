"""unitcast.sources."""
