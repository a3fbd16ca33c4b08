"""DataFrame-to-DataFrame operators. Only :mod:`tidemark.operators.ingest` writes."""
