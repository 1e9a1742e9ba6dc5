"""Operators for training-data pipelines: mixing, packing, chat, deduplication, quality, URL and license filters."""
