"""Bindings of the engine to the given tables, with the equivalent SQL."""
