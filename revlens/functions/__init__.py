"""Reusable column expressions (all JVM-side built-ins, no UDFs)."""

from revlens.functions.measures import helpful_percent, percent_of_total, review_length, share_percent

__all__ = ["helpful_percent", "percent_of_total", "review_length", "share_percent"]
