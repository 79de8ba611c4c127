"""Regional map-data analytics as Spark DataFrame jobs."""
