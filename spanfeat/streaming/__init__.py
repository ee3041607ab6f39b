"""Scoring of request records, in batch and on a stream."""
