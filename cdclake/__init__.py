"""Keep lake tables in step with an operational database, as Spark DataFrame jobs."""
