"""Operators for preparing language-model training data; each module is one operator."""
