"""Core sources of the engine."""
