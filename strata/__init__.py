"""strata: Spark-native log ingest, listing/client matching and segment counting.

Every operator is a DataFrame transformation; nothing loops over rows on the
driver. See README.md for the module map.
"""

__version__ = "0.1.0"
