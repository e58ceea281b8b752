"""Machine-fleet analytics as Spark jobs."""
