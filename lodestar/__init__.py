"""lodestar: a Spark-native retail star-schema analytics library.

Raw order, item, customer, product and category tables go through cleaning
(silver), a star schema with SHA-256 surrogate keys and a generated calendar
(gold), an idempotent keyed upsert on catalog tables, data-skipping
layout, a quality gate, and five reporting views with named, parameterised
reads and guarded read-only SQL.  Every function takes and returns Spark
DataFrames; nothing is collected except tiny, bounded results.
"""

__version__ = "0.1.0"
