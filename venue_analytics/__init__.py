"""venue_analytics: monthly venue/social reports as Spark DataFrame plans.

Layout
------
sources/    schemas, readers (typed or legacy string forms), report sink
functions/  Column -> Column helpers (dates, venue lists, tokens, keywords, own posts)
operators/  active places, place-post matching, the seven reports, map folding, checks
plans/      report runner, driver-table stand-ins, registered queries + oracle SQL
"""

from venue_analytics.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
