"""Spark-native building, auditing and applying of text classifiers."""
