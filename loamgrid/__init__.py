"""Land-cover change and ecosystem-service analytics as Spark jobs."""
