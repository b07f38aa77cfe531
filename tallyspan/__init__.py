"""Analytics on tables and event streams, written as Spark DataFrame jobs."""
