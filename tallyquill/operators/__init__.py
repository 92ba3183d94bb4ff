"""Relational operators over questions, analyses, runs and vocabularies."""
