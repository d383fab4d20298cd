"""Spark-native analytics for retail-panel deliveries (market x product x period measures)."""
