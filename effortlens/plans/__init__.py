"""Whole runs: landed payloads in, stored tables and digests out."""
