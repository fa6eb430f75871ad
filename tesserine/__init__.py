"""tesserine: a PySpark-native analytics engine for generated-asset datasets."""
