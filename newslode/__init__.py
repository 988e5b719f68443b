"""A Spark-native market-text intelligence engine."""
