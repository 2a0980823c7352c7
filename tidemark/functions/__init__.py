"""Column expressions; all stay inside Spark SQL."""
