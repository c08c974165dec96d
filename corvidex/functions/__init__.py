"""Column expressions, all of them built-in functions unless said otherwise."""
