"""Plans of the tallymark engine."""
