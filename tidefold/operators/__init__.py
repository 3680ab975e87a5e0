"""Mirror fold, snapshot tables, schema changes, initial load, maintenance and progress."""
