"""Creator-account analytics as Spark DataFrame operators."""
