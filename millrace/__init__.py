"""millrace: prepare, profile and classify large tables with PySpark."""
