"""Readers: metric tables, source trees, file lists and archives."""
