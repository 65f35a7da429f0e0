"""unitcast.functions."""
