"""Readers of landed files and writers of landed tables."""
