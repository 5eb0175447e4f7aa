"""Outputs: tuple-form text reports."""
