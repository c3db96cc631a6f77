"""Sources: seeds, URL lists and the raw landing zone."""
