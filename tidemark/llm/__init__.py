"""Training-data operators: ten corpus operators and their queries (nothing else in the library imports this)."""
