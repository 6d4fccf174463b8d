"""Transaction-monitoring mart for financial-crime reporting, as Spark DataFrame jobs."""
