"""Whole jobs composed from operators. Most are one lazy plan; the docstrings say where a small table is written on the way."""
