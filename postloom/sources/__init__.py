"""Readers, stored tables and writers."""
