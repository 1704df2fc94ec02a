"""Spark-native analytics for ordered event logs of team sport."""
