"""Readers, writers and run state."""
