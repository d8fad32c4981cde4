"""Marketing-event and ad-cost warehouse expressed as Spark DataFrame, SQL and Structured Streaming jobs."""
