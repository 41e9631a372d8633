"""Readers, stage tables and writers."""
