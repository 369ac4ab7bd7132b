"""Readers and role bindings."""
