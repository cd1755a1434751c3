"""Readers, file lists, layouts and table writers."""
