"""The spark-submit job and the catalogue of registered queries with their DuckDB oracles."""
