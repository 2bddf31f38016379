"""Lazy DataFrame -> DataFrame operators for the review analyses and jobs."""
