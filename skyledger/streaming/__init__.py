"""Structured Streaming pipelines that keep each answer current as records arrive."""
