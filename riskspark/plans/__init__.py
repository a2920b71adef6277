"""Variable metadata and the plan that joins a sample to the tables of its variables."""
