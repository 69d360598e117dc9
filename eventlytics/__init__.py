"""PySpark-native analytics for events, two-sided contests and their entities."""
