"""Column functions and Arrow UDFs."""
