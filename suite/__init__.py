"""Registered queries and their oracle SQL, by topic."""

from suite import detection, loads, profiles, runlogs, schemas, stores  # noqa: F401
from suite.base import ORACLES, QUERIES  # noqa: F401
