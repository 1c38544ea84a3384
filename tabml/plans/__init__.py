"""Plans: job specifications, the job runner and the query catalogue."""
