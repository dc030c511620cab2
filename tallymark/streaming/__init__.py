"""Streaming of the tallymark engine."""
