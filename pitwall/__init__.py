"""Point-in-time features, clustering and model evaluation as Spark jobs."""
