"""Online-shop data quality and analytics as plain Spark DataFrame jobs."""
