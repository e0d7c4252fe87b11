"""tallyline: PySpark-native analytics over document-derived tables."""
