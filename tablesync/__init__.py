"""Table replication and change tracking on Spark DataFrames."""

__version__ = "0.1.0"
