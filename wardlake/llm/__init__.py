"""Operators for preparing training text: near and exact duplicates, page text, personal data, quality rules,
chat formatting, token counts, source mixing, packing and toxicity. Nothing else in the library imports this folder."""
