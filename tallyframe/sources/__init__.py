"""Readers, writers and the table log: everything that touches storage."""
