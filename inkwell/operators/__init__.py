"""Operators over documents, cards, clusters and representatives."""
