"""Short-text sentiment analytics as Spark DataFrame jobs."""
