"""DNS traffic analytics as Spark jobs."""
