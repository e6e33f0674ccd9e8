"""Jobs and the registered query catalogue (with its SQL oracle)."""
