"""Model preparation, training and search with Spark ML."""
