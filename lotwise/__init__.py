"""Lotwise: listing-page analytics and crawl-health models on PySpark."""
