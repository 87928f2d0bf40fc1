"""Reusable DataFrame operators: ingest, history, neighbours, size checks, quality."""
