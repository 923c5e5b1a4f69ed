"""Record tracking and data quality as PySpark DataFrame jobs."""
