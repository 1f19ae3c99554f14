"""Operators over text corpora: deduplication, privacy, scoring, search and tokenization."""
