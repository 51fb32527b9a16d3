"""Readers and the adapters from raw tables to canonical records."""
