"""A PySpark-native engine for document-curve analytics."""
