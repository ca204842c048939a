"""Operators for training-data pipelines, with their queries and oracle SQL (`queries`)."""
