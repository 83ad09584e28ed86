"""Whole jobs composed from operators, sources and sinks; join helpers."""
