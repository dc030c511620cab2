"""Operators of the tallymark engine."""
