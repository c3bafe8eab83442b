"""The engine's tables derived from the benchmark tables, and the queries on them."""
