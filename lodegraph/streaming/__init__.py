"""lodegraph.streaming."""
