"""Column functions built only from Spark built-ins (no Python UDFs)."""
