"""Landed documents, files, snapshots and sinks."""
