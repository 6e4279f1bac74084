"""Structured Streaming forms of the monitoring and session operators."""
