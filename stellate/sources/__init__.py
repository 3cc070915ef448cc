"""Readers, landing loads, catalog metadata and snapshot publishing."""
