"""Delimited sources and sinks. Relational tables come from the caller (`spark.read.jdbc`, Parquet, ...)."""
