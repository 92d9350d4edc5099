"""Operators of a training-data pipeline: documents and web pages in, verdicts, spans and tokens out."""
