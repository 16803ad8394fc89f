"""Payment-risk analytics expressed as Spark DataFrame jobs."""
