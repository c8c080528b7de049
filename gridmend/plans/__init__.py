"""End-to-end jobs, derived test cubes and the query catalogue."""
