"""Freshet: flood-impact analytics as lazy Spark plans, and training-data operators in ``freshet.llm``."""
