"""Spark-native analytics for amplicon sequencing reads."""
