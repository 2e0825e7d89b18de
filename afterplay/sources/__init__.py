"""Readers, writers and the adapters that yield canonical event rows."""
