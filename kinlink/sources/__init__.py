"""Readers, writers and table configuration."""
