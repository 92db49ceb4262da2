"""Operators of a training-data pipeline: search, packing, chat, mixing, language, duplicates, licences, quality, counts."""
