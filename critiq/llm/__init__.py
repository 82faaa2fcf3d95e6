"""Training-data operators: one module each, and the registry of their queries."""
