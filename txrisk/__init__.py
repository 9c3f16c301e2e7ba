"""txrisk: transaction-risk analytics expressed as Spark DataFrame plans.

Sub-packages:
  sources    readers and writers (Parquet/CSV tables, day partitions, models, run log)
  functions  column expressions (calendar flags, message codecs, portable hashes, statistics)
  operators  relational operators (rolling features, splits, labels, joins, metrics, models)
  plans      the registered queries and their DuckDB oracle SQL
  streaming  Structured Streaming scoring of message streams
"""

__version__ = "0.1.0"
