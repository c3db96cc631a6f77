"""DataFrame operators: listing and detail rows, crawl graph, health models."""
