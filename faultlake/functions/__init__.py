"""Core functions of the engine."""
