"""Queries over the test tables, one per operator, with equivalent SQL."""
