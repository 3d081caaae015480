"""A Spark-native engine that standardises heterogeneous parts-change tables."""
