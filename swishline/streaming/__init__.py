"""Structured Streaming: the scorer and the continuously kept reports."""
