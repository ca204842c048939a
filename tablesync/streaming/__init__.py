"""Scheduled increments: bounded batches over a growing table."""
