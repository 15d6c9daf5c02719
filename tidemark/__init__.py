"""A PySpark-native engine for database change streams."""
