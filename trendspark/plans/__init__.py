"""Query plans: the catalogue of registered queries and the batch jobs."""
