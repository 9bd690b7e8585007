"""Named query plans (the ``queries()`` registry) and their DuckDB oracle SQL."""
