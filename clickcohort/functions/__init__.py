"""Column expressions: no function here reads or shuffles data."""
