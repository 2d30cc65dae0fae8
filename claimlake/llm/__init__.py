"""Operators for preparing large training corpora (see README, "Corpus operators")."""
