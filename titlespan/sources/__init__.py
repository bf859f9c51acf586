"""Readers, writers and sample generators."""
