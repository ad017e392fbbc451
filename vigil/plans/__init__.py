"""Jobs and the registered query catalog with its SQL oracles."""
