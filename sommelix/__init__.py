"""Spark-native analytics for yearly restaurant guides, departmental statistics and wine regions."""
