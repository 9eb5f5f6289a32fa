"""Streaming sinks, metrics and the job that runs them."""
