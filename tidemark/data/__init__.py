"""Data shipped with the engine."""
