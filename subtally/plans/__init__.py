"""Staging views, marts, dashboard aggregates, analyses and the batch job."""
