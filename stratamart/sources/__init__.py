"""Readers, layer storage, warehouse sink and session."""
