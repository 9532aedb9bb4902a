"""Column expressions: packed weather fields, times, airport codes, delay status."""
