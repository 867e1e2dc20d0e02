"""Operators of a training-data pipeline: de-duplication, tokenizing, sharding,
chat rendering, PII, mixing, token files and quality rules, with their queries."""
