"""Operators of a training-data pipeline: search, scans, token counts,
formatting, filters and joins over documents, pages, conversations and
embeddings. Nothing else in the package imports this subpackage."""
