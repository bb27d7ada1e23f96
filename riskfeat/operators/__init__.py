"""Feature operators: each returns a DataFrame keyed by the entity column."""
