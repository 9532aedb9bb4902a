"""Flight-delay and weather analytics as composable PySpark DataFrame operators."""
