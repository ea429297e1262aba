"""Operators on text and corpora; nothing outside this package imports it."""
