"""lodegraph: a DataFrame-first engine that turns marked documents into a property graph and queries it."""

__version__ = "0.1.0"
