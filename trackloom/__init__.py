"""trackloom: a PySpark-native engine for rail delay analytics."""
