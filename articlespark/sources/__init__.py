"""Readers, writers and reusable stages."""
