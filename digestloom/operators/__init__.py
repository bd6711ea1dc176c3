"""Operators on digest sets."""
