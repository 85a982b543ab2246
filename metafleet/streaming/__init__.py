"""Snapshots, changes and status as streams."""
