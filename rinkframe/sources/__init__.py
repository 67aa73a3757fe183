"""Readers that bring captured documents into the canonical tables."""
