"""The parts a store is made of, each a set of DataFrame operations."""
