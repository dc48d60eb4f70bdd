"""Operators of a training-data pipeline (chat formatting, near duplicates, licences, personal data,
language, decontamination, main text, tokens, embeddings, quality). Nothing else in the library
imports this subpackage; ``registry`` names its queries."""
