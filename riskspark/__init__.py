"""A PySpark-native engine for credit-risk model operations."""
