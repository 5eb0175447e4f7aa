"""Joins, the skew-safe nearest-answer scan, per-question and per-tag aggregates, sort."""
