"""Readers, writers, the landing zone and the test-table mapping."""
