"""Plans: the reference's pipeline as configuration, and the query catalogue."""
