"""Structured Streaming front ends for the batch operators."""
