"""Commerce and leasing analytics as plain Spark DataFrame jobs."""
