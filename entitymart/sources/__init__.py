"""Landed payloads to normalised records, and table readers and writers."""
