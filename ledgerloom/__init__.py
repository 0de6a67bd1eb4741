"""Spark-native commerce settlement analytics, with a separate corpus-preparation subpackage."""
