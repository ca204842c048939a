"""Replication workflows composed of sources, operators and sinks."""
