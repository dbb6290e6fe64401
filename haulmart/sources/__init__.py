"""Feeds, test-table binding, working tables and published snapshots."""
