"""Plans: the stand-ins over the given tables, the registered queries with
their oracle SQL, end-to-end jobs for the three entry points, and the plan
report."""
