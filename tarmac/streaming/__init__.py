"""Continuous landing: the same ingest, driven by newly arriving files."""
