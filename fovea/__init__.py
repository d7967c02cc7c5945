"""Feature extraction and dimensionality reduction for large file collections, on Spark."""
