"""Structured Streaming wiring around the operators."""
