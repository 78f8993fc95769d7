"""Plans: named chains of operators (warehouse build, forecast, pipeline),
the registry of checked queries and their DuckDB oracle SQL."""
