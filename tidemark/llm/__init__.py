"""Operators for training data: filtering, deduplication, decontamination, counting and mixing of documents."""
