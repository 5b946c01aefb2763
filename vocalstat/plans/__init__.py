"""Query plans: driver-table queries (with their SQL oracles) and the pipeline."""
