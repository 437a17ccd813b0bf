"""Operators for preparing language-model training data; nothing outside imports this folder."""
