"""stellate: a Spark-native dimensional-warehouse loader.

Typed landing loads, key/reference audits, slowly-changing-dimension
maintenance (SCD 1/2/3/4) with a row-level change feed, a calendar
dimension, a star-join fact load and checked snapshot publishing, all
written on the DataFrame API so Catalyst and AQE plan the work.
"""

__version__ = "0.1.0"
