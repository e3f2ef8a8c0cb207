"""Layered table pipelines (raw history, staging snapshot, contract tables) on Spark."""
