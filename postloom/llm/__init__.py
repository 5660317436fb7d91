"""Operators for training data: packing, tokens, duplicates, extraction, languages, language models."""
