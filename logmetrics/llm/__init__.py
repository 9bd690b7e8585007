"""Training-data operators: language, quality, near-duplicate, filtering and packing jobs.

Nothing else in the package imports this folder.  Each operator module has a general
function over any table with the named columns; ``queries`` holds the thin registered
queries and ``oracle`` the DuckDB SQL where SQL can express the result."""
