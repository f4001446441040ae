"""A Spark-native engine for curating territorial records and document corpora."""
