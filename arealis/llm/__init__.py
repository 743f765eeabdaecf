"""Operators for training-data pipelines, each usable on any DataFrame of documents."""
