"""Operators for large training-text pipelines; nothing outside this folder imports it."""
