"""Usage-event and security-event analytics as PySpark DataFrame operators."""
