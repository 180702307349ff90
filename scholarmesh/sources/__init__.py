"""Readers, writers and the table contracts between stages."""
