"""Operators of a large-scale training-data pipeline, and their registered queries.

Nothing else in the library imports this subpackage; it only uses ``venue_analytics.session``.
"""
