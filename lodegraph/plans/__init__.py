"""Session helpers and named query plans."""
