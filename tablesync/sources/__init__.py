"""Scans and sinks: lake tables, plain files, JDBC, logs and exports."""
