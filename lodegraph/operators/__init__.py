"""lodegraph.operators."""
