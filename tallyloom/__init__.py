"""Market surveillance and news analytics as Spark DataFrame operators."""
