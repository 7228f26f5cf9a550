"""Layer operators: silver, gold star schema, marts, quality checks, loads."""
