"""Readers and writers: landed extracts, weather payloads, bronze, seeds, lake tables."""
