"""Streams."""

from .inbox import inbox_files, ingest_inbox, ingested, take_files
