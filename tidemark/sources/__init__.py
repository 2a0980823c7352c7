"""Scans, codecs and sinks."""
