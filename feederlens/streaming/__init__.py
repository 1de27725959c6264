"""Structured Streaming form of the analysis."""
