"""Readers, history table, documents, latest-N views and model tables."""
