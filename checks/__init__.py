"""Sample inputs derived from the given tables, the query catalogue and its SQL twins."""
