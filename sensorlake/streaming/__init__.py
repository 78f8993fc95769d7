"""Structured Streaming entry points.

The reference has no streaming operator: late data is handled by replacing
every month touched by the trailing week.  ``landing`` runs that same
month replacement as a Structured Streaming job over a landing folder of
month exports, so newly landed files are picked up incrementally.
"""
