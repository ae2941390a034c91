"""Customer analytics as Spark DataFrame jobs."""
