"""Sources of the tallymark engine."""
