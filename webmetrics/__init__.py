"""webmetrics — a Spark-native web/app analytics engine.

Events (visitor, session, page view, click) are validated, routed into typed
tables, enriched through lookups, joined into a denormalised page-view fact and
a re-summable visitor time series, and answered by parameterised reports.
Everything is expressed with the DataFrame API so Catalyst/AQE plan it.
"""

__version__ = "0.1.0"
