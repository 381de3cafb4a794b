"""A PySpark-native analytics engine for multilingual news and text corpora."""
