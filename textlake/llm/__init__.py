"""Operators for preparing training data of language models, and their queries."""
