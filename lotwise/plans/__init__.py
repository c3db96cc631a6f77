"""Query catalogue and the pages it synthesises from relational tables."""
