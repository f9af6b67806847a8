"""Core operators of the engine."""
