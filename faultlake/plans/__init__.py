"""Core plans of the engine."""
