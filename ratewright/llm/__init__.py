"""Operators for training-data pipelines: near duplicates, scoring, packing, formatting, filters."""
