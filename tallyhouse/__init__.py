"""Banking warehouse and data marts as PySpark batch jobs."""
