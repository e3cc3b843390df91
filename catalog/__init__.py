"""The given tables presented as the dirty sources, and the registered queries."""
