"""Query plans: the registered query catalogue and its SQL oracles."""
