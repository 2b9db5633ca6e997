"""A Spark-native engine for querying collections of JSON documents."""
