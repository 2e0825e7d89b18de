"""Incremental intake of player logs."""
