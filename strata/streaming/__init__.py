"""Structured Streaming form of the rolling look-back mean."""
