"""Readers and writers: collections, message bodies, appended tables and snapshots."""
