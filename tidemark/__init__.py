"""Spark-native engine for monitoring feeds of block chains: typed events, contract queries, data processing."""
