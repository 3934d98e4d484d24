"""Batch pipelines: each answers one question from cleaned flights or coupons."""
