"""Daily market-data engine written as Spark DataFrame jobs."""
