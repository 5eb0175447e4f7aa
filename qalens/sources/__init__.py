"""Inputs: text-line scan, header removal, strict dump ingest, views of the driver tables."""
