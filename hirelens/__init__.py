"""hirelens: job-posting analytics as PySpark DataFrame operations."""
