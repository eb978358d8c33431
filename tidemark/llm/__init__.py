"""Operators for training data: files of token ids, near duplicates, mixing, filters, sharding, models, archives."""
