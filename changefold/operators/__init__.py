"""DataFrame -> DataFrame operators of the CDC engine."""
