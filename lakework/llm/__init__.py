"""Operators for training data: shard, filter, deduplicate, mix, pack, tokenize."""
