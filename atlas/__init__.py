"""atlas: Spark operators, builders and gates for open map data."""
