"""quirekit: a PySpark-native engine for paginated-document data."""
