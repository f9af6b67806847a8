"""Spark-native engine for technical documents, fault-code records and crawled articles."""
