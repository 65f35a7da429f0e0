"""unitcast.operators."""
