"""Version-history analytics as Spark DataFrame operators."""
