"""captionloom: a PySpark-native engine for building and curating caption and tag datasets."""
