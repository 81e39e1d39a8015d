"""Spark-native analytics for transcripts of long spoken proceedings."""
