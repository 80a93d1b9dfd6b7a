"""Operators of a training-data pipeline: text extraction, labels, filters, duplicates, mixing."""
