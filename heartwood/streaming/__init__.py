"""Streaming jobs over the engine's operators."""
