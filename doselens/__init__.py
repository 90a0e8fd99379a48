"""Drug-safety analytics as PySpark DataFrame jobs."""
