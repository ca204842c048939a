"""Run this subpackage's queries against their oracle SQL: python -m tablesync.llm.check [sf_dir] [name ...]"""

from __future__ import annotations

import sys

import tablesync.llm.queries  # noqa: F401
from suite import check
from tablesync.llm.base import ORACLES, QUERIES

if __name__ == "__main__":
    check.QUERIES, check.ORACLES = QUERIES, ORACLES
    sys.exit(check.main(sys.argv[1:] if len(sys.argv) > 1 else ["/root/testdata/sf0.01", *QUERIES]))
