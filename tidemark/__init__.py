"""Change-data analytics expressed as Spark DataFrame jobs."""
