"""Readers for raw topics, change streams, tables and the dated lake."""
