"""A PySpark-native engine for listing analytics and training-data preparation."""
