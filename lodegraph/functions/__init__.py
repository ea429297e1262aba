"""lodegraph.functions."""
