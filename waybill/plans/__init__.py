"""Whole data flows composed from operators."""
