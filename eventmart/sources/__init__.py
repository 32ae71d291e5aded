"""Readers and writers of the raw layer."""
