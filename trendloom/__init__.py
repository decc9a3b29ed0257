"""trendloom: a PySpark-native trend-analytics engine."""
