"""Whole jobs composed of operators: prepare, train, index."""
