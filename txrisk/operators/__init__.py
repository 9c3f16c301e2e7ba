"""Relational operators over transaction tables."""
