"""``python -m venue_analytics SOURCE SINK [--month 2015Jan] [--report content] ...``: the monthly job."""

from venue_analytics.plans.jobs import main

if __name__ == "__main__":
    main()
