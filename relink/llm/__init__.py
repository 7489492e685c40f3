"""Operators for training-data pipelines: scoring, matching, packing, archiving and formatting of documents."""
