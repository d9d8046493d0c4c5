"""A Spark-native engine that turns text into scored, labelled and aggregated value signals."""
