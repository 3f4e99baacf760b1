"""Incremental ingest: the batch normalisers applied to newly arrived files."""
