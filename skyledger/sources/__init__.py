"""Readers: raw exports, cleaned tables, archives, topics and stored results."""
