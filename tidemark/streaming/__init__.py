"""Streaming sources, sinks and the price jobs."""
