"""Sinks: the event envelope, its outbox, alerts and JSON lines."""
