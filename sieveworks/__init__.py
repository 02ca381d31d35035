"""Spark-native building blocks for question-answer evaluation sets over document corpora."""
