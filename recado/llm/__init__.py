"""Operators of a training-data pipeline: search, mixing, de-duplication, extraction, formatting, filters, packing, quality."""
