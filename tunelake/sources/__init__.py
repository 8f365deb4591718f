"""Readers and writers: examples, metrics, logs, artifacts, results."""
