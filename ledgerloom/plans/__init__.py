"""End-to-end plans, the registered query set and its SQL oracles."""
