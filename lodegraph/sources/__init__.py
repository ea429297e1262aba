"""lodegraph.sources."""
