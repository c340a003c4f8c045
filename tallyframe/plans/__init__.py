"""Compositions of operators with storage: the daily run and the SQL serving layer."""
