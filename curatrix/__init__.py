"""curatrix: a Spark-native engine for building and analysing verified instruction-tuning data."""
