"""Tidemark: corpus preparation, chat formatting, run telemetry and experiment analytics on Spark."""
