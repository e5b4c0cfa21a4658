"""Training-data operators and their queries. Nothing outside this package imports it."""
