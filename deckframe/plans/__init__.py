"""Deck-named analytics built from the generic operators."""
