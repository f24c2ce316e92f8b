"""Operators of a training-data pipeline: tokens, chat, packing, filters, duplicates, secrets."""
