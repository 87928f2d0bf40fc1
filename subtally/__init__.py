"""Subscription revenue analytics expressed as Spark DataFrame transformations."""
