"""Readers, writers and the tables shared between queries."""
