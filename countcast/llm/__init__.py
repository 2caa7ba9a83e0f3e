"""Operators for training-data pipelines: mixing, packing, scoring, search, filtering and near-duplicate removal."""
