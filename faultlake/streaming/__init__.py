"""Core streaming of the engine."""
