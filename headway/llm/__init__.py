"""Operators for training data; their queries are in ``headway.llm.queries``."""
