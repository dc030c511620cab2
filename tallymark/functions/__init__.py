"""Functions of the tallymark engine."""
